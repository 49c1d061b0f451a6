"""A transport for the sources: payloads from files named slot-position, answers from files named after their request."""

import os
import time


def _files(slot, options):
    return sorted((int(f.split("-")[1]), f) for f in os.listdir(options["inbox"]) if f.startswith(f"{slot}-"))


def head(slot, timeout, options):
    return max((p for p, _ in _files(slot, options)), default=-1)


def poll(slot, after, timeout, options):
    for position, name in _files(slot, options):
        if position > after:
            with open(f"{options['inbox']}/{name}", "rb") as f:
                yield position, f.read()


broken = {"left": 0}


def unsteady(slot, after, timeout, options):
    """Breaks off after every payload as often as ``broken`` says."""
    for step in poll(slot, after, timeout, options):
        yield step
        if broken["left"]:
            broken["left"] -= 1
            raise ConnectionError("gone")


def slow(slot, after, timeout, options):
    yield after + 1, b"x"
    time.sleep(30)


def answer(request, timeout, options):
    path = f"{options['inbox']}/{request.replace('/', '_')}.json"
    if not os.path.exists(path):
        return None
    with open(path) as f:
        return f.read()
