"""Vocabulary files, pre-token patterns and character classes of the byte BPE.

The path of a vocabulary is always a parameter; executors open it by the same
path (on a cluster: an installed package or a shared mount).
"""

from __future__ import annotations

import json
import os
import re

# Fixed values of the byte-level BPE format: the split pattern, stated with
# explicit classes, and the byte <-> character table.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{S}{LL}{NN}]+|[{S}]+(?![^{S}])|[{S}]+"
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"

#: Characters up to here have had their classes in every Unicode version in use.
STABLE = "ɏ"
UNSTABLE = re.compile(f"[^\x00-{STABLE}]")
#: Two white-space characters in a row (then a blank need not begin a pre-token).
DOUBLE_WHITE = re.compile(f"[{WHITE}]{{2}}")
LONE_BLANK = re.compile(f"(?<=[^{WHITE}])(?= [^{WHITE}])")


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_chars() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable bytes stand for
    themselves, the others take the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> tuple[dict[bytes, int], dict[tuple[int, int], tuple[int, int]], dict[str, int]]:
    """Token bytes -> id; merges (left id, right id) -> (rank, merged id); special strings -> id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    back = byte_chars()
    name = {t: bytes(back[c] for c in t) for t in spec["model"]["vocab"]}
    vocab = {name[t]: i for t, i in spec["model"]["vocab"].items()}
    merges = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = (bytes(back[c] for c in x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
        merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
    return vocab, merges, {t["content"]: t["id"] for t in spec["added_tokens"]}


def blank_pieces(text: str) -> list[str]:
    """Cuts a text before blanks that stand alone between other characters;
    every such cut is a boundary of pre-tokens, so pieces can be encoded alone."""
    if DOUBLE_WHITE.search(text):
        return LONE_BLANK.split(text)
    return text.replace(" ", "\x00 ").split("\x00") if "\x00" not in text else LONE_BLANK.split(text)


def library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)
