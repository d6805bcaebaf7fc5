"""Token ids of texts by a public word-level BPE vocabulary, as packed integers.

The library is asked once for each distinct word; texts made only of the
characters in ``PLAIN`` are split here the way the vocabulary's own rules split
them, every other text goes through the library as a whole. Both give the same
ids (tests/llm compares them). A vocabulary with other rules than ``RULES`` goes
through the library with every text.
"""

from __future__ import annotations

import json
import re
import sys
import types
from array import array

_LETTERS = "a-zªµºß-öø-ɏ"
#: capitals up to U+024F whose lower case lies beyond, outside _LETTERS: Ə, Ɓ, Ɗ and others
_FAR = "".join(c for c in map(chr, range(0x180, 0x250)) if not re.fullmatch(f"[{_LETTERS}]", c.lower()))
#: Characters whose lower case, composition and class need no context: ASCII but for odd controls, and
#: precomposed Latin letters. The rest, the special-token marker included, goes through the library.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-±´-¸º»¿-įı-ſ" + "".join(c for c in map(chr, range(0x180, 0x250)) if c not in _FAR) + "‐-‧€]*")
#: fixed values: the vocabulary's split rule for lower-case text, with the letters of PLAIN spelt out
SPLIT = re.compile(rf"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\s{_LETTERS}0-9]+")
#: the vocabulary's rules that SPLIT and lower() restate
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed", "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None, "truncation": None, "padding": None,
}


class _Learnt(dict):
    """Word -> packed ids; an unknown word is learnt when it is first asked for."""

    def __init__(self, learn) -> None:
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        got = self[word] = self.learn(word)
        return got


class TokenIds:
    """``packed(text)``: the ids as little-endian unsigned 32-bit integers.

    At most about ``remembered`` words are kept; then learning starts afresh.
    """

    def __init__(self, path: str, remembered: int = 600_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        marked = all(t["content"].startswith("<|") and t["special"] and not t["normalized"] for t in spec["added_tokens"])
        #: whether the rules are those restated here
        self.split_here = marked and spec["model"]["type"] == "BPE" and all(spec[k] == v for k, v in RULES.items())
        self.remembered = remembered
        # bytes are spelt as printable characters in the vocabulary
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.spelt = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.chunks = _Learnt(self._chunk)
        self.pieces = _Learnt(self._piece)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        spelt = piece if piece.isascii() else "".join(map(self.spelt.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        parts = SPLIT.findall(chunk)
        return self.pieces[chunk] if len(parts) == 1 else b"".join(map(self.pieces.__getitem__, parts))

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.split_here or PLAIN.fullmatch(text) is None or "<|" in text:
            return self._whole(text)
        if len(self.chunks) > self.remembered:  # what is remembered stays bounded
            self.chunks.clear()
            self.pieces.clear()
        return b"".join(map(self.chunks.__getitem__, text.lower().split()))


def shared(path: str) -> TokenIds:
    """One TokenIds a worker process and path, kept from task to task (functions come to workers
    by value, so what they keep needs a module that stays)."""
    kept = sys.modules.setdefault("_strata_llm_kept", types.ModuleType("_strata_llm_kept")).__dict__
    if path not in kept:
        kept[path] = TokenIds(path)
    return kept[path]
