"""Readers of public tokenizer files; a path is always a parameter, files are never copied."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache, partial

import public_tokenizers
import tiktoken

#: File of the production byte-level BPE.
BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path(path: str | None = None, name: str = BYTE_BPE) -> str:
    """``path`` itself, or where the installed package keeps ``name``."""
    return path or public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level BPE files.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in byte order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_bpe(path: str | None = None) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` JSON file as ranked byte strings.

    ``encode_ordinary`` gives the ids of the file's own library where special
    tokens' strings count as plain text, ``encode(text, allowed_special="all")``
    those of the library at its defaults, where an added token's string is that
    token (tests compare both), in a fraction of its CPU time.  Ids of such a
    file are its merge ranks.  An added token that takes more than its exact
    string, or that is the beginning of another, is refused.
    """
    with open(tokenizer_path(path), encoding="utf-8") as f:
        spec = json.load(f)
    added = spec.get("added_tokens", ())
    special = {t["content"]: t["id"] for t in added}
    if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip")) or any(a != b and b.startswith(a) for a in special for b in special):
        raise ValueError(f"added tokens that need more than an exact match: {sorted(special)}")
    as_byte = byte_alphabet()
    ranks = {bytes(as_byte[c] for c in piece): rank for piece, rank in spec["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


#: White space of the pre-tokenising pattern (Unicode's White_Space), and runs of it too long for a backtracking match.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = re.compile(f"[{WHITE_SPACE}]{{4096,}}")


def encoder(path: str | None = None, added_tokens: bool = False) -> Callable[[str], list[int]]:
    """text -> ids, for texts of any length; ``added_tokens`` as ``encode`` of ``byte_bpe`` reads them.

    The pattern makes one piece of a run of white space, without its last
    character where more text follows.  Long runs are cut out by that rule and
    merged as the one piece they are, as the pattern would backtrack through
    them beyond its stack.
    """
    bpe = byte_bpe(path)
    encode = partial(bpe.encode, allowed_special="all") if added_tokens else bpe.encode_ordinary

    def ids(text: str) -> list[int]:
        out: list[int] = []
        at = 0
        for run in LONG_RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += encode(text[at : run.start()])
            out += bpe._encode_single_piece(text[run.start() : end])
            at = end
        return out + encode(text[at:]) if at else encode(text)

    return ids
