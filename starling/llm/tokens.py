"""Byte-level BPE ids of a public tokenizer file, by the faster of two equal encoders.

The file is a ``tokenizers`` JSON (its path is a parameter, and it must exist on every
executor).  Where its vocabulary numbers the merges in order, merging by rank gives the same
ids as merging by pair, so the ids come from ``tiktoken`` built from that same vocabulary;
otherwise, and for texts with huge runs of white space, from ``tokenizers`` itself.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np

# fixed value: how a byte-level BPE cuts text into pieces before merging
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_SPACE = re.compile(r"\s{2000}")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """``encode(text) -> uint32 ids`` without special tokens (their names are ordinary text)."""
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True

    def slow(text: str) -> np.ndarray:
        return np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    ordered = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))
    pre = spec.get("pre_tokenizer") or {}
    if not (ordered and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer")):
        return slow
    import tiktoken
    letters = _byte_letters()
    special = {t["content"] for t in spec.get("added_tokens", ())}
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
    fast = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if _LONG_SPACE.search(text):
            return slow(text)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode
