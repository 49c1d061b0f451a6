"""Byte-level BPE by a depth-first walk over the trie of distinct words.

The encoding of a byte string ends in exactly one token t for which the encoding of the string without t ends in a token
that t may follow, so a string's encoding is known from the last tokens of its prefixes. In the trie of all distinct words
every node is such a prefix: a walk from the root computes each node's last token once, from the last tokens of its
ancestors, however many words share it. Sorted words visit the trie depth first, so the walk needs only the last
tokens on the current path: a word keeps those of the prefix it shares with the word before it.

Whether token b may follow token a (the encoding of their bytes together is just a, b) is decided on the merge
tree: undo the merges along the cut, youngest first; the pair is broken if two neighbours across the cut would have merged
before the younger of the tokens around them was made.
"""

import base64
import struct
from collections.abc import Iterable
from pathlib import Path

import regex

# Fixed value: the public pattern that cuts a text into words before byte-level BPE of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORDS_KEPT = 1_000_000


def read_ranks(path: str | Path) -> dict[bytes, int]:
    """The vocabulary of a file of lines "base64 of the token, blank, id"; an id is also the rank of its merge."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class TrieEncoder:
    """Encodes words, and keeps what it has encoded up to WORDS_KEPT words (then it starts anew)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.follows: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.split = regex.compile(PATTERN).findall

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made the token; None for a single byte."""
        text = self.bytes_of[token]
        if len(text) == 1:
            return None
        if token not in self.halves:
            parts = [text[i : i + 1] for i in range(len(text))]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(a + b, token), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank >= token:
                    raise ValueError(f"no merge makes token {token}")
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]])
        return self.halves[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the encoding of the bytes of both tokens together is the two tokens."""
        known = self.follows.get((left, right))
        if known is None:
            known = self.follows[left, right] = self._unbroken(left, right)
        return known

    def _unbroken(self, left: int, right: int) -> bool:
        made = 1 << 60  # rank of the youngest merge undone so far; an older one across the cut would have come first
        while True:
            across = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if across is not None and across < made:
                return False
            l_parts, r_parts = self._parts(left), self._parts(right)
            if l_parts is None and r_parts is None:
                return True
            # of equal tokens the left one was merged first, so the right one is the younger
            if r_parts is None or (l_parts is not None and left > right):
                made, left = left, l_parts[1]
            else:
                made, right = right + 1, r_parts[0]

    def add(self, words: Iterable[str]) -> None:
        """Encode words that are not known yet."""
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        path: list[int] = []  # last token of each prefix on the current path, from one byte on
        before = b""
        get = self.ranks.get
        for text, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            shared = 0
            for a, b in zip(before, text):
                if a != b:
                    break
                shared += 1
            del path[shared:]
            for end in range(shared + 1, len(text) + 1):
                for start in range(max(0, end - self.longest), end):
                    token = get(text[start:end])
                    if token is not None and (start == 0 or self.may_follow(path[start - 1], token)):
                        path.append(token)
                        break
            tokens, end = [], len(text)
            while end:
                tokens.append(path[end - 1])
                end -= len(self.bytes_of[path[end - 1]])
            self.words[word] = struct.pack(f"<{len(tokens)}i", *reversed(tokens))
            before = text

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Ids, as packed 4-byte integers, of pieces cut where no word reaches across."""
        cut = [self.split(p) for p in pieces]
        unknown = {w for words in cut for w in words} - self.words.keys()
        if unknown:
            cleared = len(self.words) > WORDS_KEPT
            self.add({w for words in cut for w in words} if cleared else unknown)
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in cut]
