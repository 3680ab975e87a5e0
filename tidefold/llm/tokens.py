"""Token ids of a public byte-level BPE vocabulary inside Arrow batches.

The vocabulary file is read once on the driver by its path (a parameter) and travels to the
workers with the function; its size is that of the file.  The ids equal those of the
``tokenizers`` library for the JSON file: both apply the same merges to the same pieces, and an
added token of the JSON file that stands in a text becomes its own id (a test compares them).  A
``.tiktoken`` file has no added tokens; there such strings are ordinary text.
"""

from __future__ import annotations

import json
from functools import lru_cache


def ranks_of(path: str) -> dict[bytes, int]:
    """Byte strings to ids, from a ``.tiktoken`` rank file or a ``tokenizers`` JSON file."""
    import base64

    with open(path, "rb") as f:
        raw = f.read()
    if not path.endswith(".json"):
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
    found = json.loads(raw)
    special = {t["content"] for t in found.get("added_tokens", [])}
    shown = visible_bytes()
    return {bytes(shown[c] for c in word): i for word, i in found["model"]["vocab"].items() if word not in special}


def added_tokens_of(path: str) -> dict[str, int]:
    """Added tokens of a ``tokenizers`` JSON file and their ids; a rank file has none."""
    if not path.endswith(".json"):
        return {}
    with open(path, "rb") as f:
        added = json.load(f).get("added_tokens", [])
    found = {t["content"]: t["id"] for t in added}
    if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that take white space or whole words aren't supported")
    if any(a != b and b.startswith(a) for a in found for b in found):
        raise ValueError("an added token that begins another isn't supported")
    return found


def visible_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ranks and split pattern; pickles as data and builds its encoder once in each worker process."""

    def __init__(self, path: str, pattern: str):
        self.items = tuple(ranks_of(path).items())
        self.added = tuple(added_tokens_of(path).items())
        self.pattern = pattern

    def encoder(self):
        return _encoder(self.pattern, self.items, self.added)


@lru_cache(maxsize=2)
def _encoder(pattern: str, items: tuple, added: tuple):
    import tiktoken

    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=dict(items), special_tokens=dict(added))
