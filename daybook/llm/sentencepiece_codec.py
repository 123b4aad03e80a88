"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

A public model file gives the pieces and their log scores.  A text becomes
``▁`` plus itself with each space as ``▁``; of all ways to cut it into pieces
the one with the greatest score sum wins, found by Viterbi's algorithm.  A
character no piece covers costs the least score less 10 and becomes its UTF-8
bytes' pieces.  Ties keep the longer last piece.

As no piece holds a ``▁`` after another character (checked when the model is
read), no cut crosses from a word to the next ``▁``, so the best cut of a text
is that of its words one after another.  A worker remembers words; new words
of a batch run through the trie together, one numpy step a character.

Decoding joins pieces and bytes, turns ``▁`` into spaces and drops the one
that encoding put in front.  It restores each text exactly but for a literal
U+2581, which comes back as a space.

Cases: a null text has null ids and decodes to null; an empty text has no ids
and decodes to the empty text; very long words go through the same steps, in
batches of their own; repeated rows are encoded alike; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from daybook.llm.common import Columns, kind_of, map_columns
from daybook.llm.tokens import tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_COST = 10.0
REMEMBERED = 300_000
#: Rows of a batch: ids weigh more than their text.
ROWS = 400
#: Cells of one Viterbi table; bounds a batch's memory.
CELLS = 1 << 21


class DoubleArray:
    """A trie as two arrays: the child of state s by symbol c is base[s] + c where check says s."""

    def __init__(self, keys: list[tuple[tuple[int, ...], int]], symbols: int):
        size = 4 * sum(len(k) for k, _ in keys) // 3 + 2 * symbols + 16
        self.base, self.check = np.zeros(size, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        self.value = np.full(size, -1, dtype=np.int64)
        free = bytearray(b"\x01") * size
        free[0] = 0
        children: list[tuple[int, dict]] = [(0, self._tree(keys))]
        top = 1
        while children:
            state, tree = children.pop()
            self.value[state] = tree.pop(0, -1)
            if not tree:
                continue
            own = sorted(tree)
            at = free.find(1, max(top, own[0]))
            while not all(free[at - own[0] + c] for c in own):
                at = free.find(1, at + 1)
            base = at - own[0]
            self.base[state] = base
            for c in own:
                free[base + c] = 0
                self.check[base + c] = state
                children.append((base + c, tree[c]))
            if len(own) == 1:
                top = max(top, at)  # single children fill the array from the front
        used = int(np.flatnonzero(self.check >= 0).max(initial=0)) + symbols + 2
        self.base, self.check, self.value = self.base[:used], self.check[:used], self.value[:used]

    @staticmethod
    def _tree(keys: list[tuple[tuple[int, ...], int]]) -> dict:
        """Nested dicts by symbol; key 0 (no symbol) holds the value."""
        root: dict = {}
        for key, value in keys:
            node = root
            for c in key:
                node = node.setdefault(c, {})
            node[0] = value
        return root


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.pieces = [model.id_to_piece(i) for i in ids]
        self.unknown = model.unk_id()
        plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        if any(SPACE in self.pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece crosses a word boundary")
        self.byte_ids = {int(self.pieces[i][1:-1], 16): i for i in ids if model.is_byte(i)}
        self.score = np.array([model.get_score(i) for i in ids])
        self.unknown_score = float(self.score[plain].min()) - UNKNOWN_COST
        chars = sorted({c for i in plain for c in self.pieces[i]})
        self.symbol_of = np.zeros(0x110000, dtype=np.int64)  # 0: in no piece
        self.symbol_of[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        number = {c: k for k, c in enumerate(chars, 1)}
        self.trie = DoubleArray([(tuple(number[c] for c in self.pieces[i]), i) for i in plain], len(chars) + 1)
        self.longest = max(len(self.pieces[i]) for i in plain)
        as_byte = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.surface = [as_byte.get(i, b"" if model.is_control(i) else self.pieces[i].encode()) for i in ids]
        alone = "".join(c for c in "\n\r\t" if c not in number)
        self.words = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.seen: dict[str, tuple[int, ...]] = {}

    def best_cuts(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each word, words of like length together."""
        out: list[tuple[int, ...]] = [()] * len(words)
        order = sorted(range(len(words)), key=lambda k: -len(words[k]))
        at = 0
        while at < len(order):
            most = max(1, CELLS // (len(words[order[at]]) + 1))
            group = order[at : at + most]
            at += len(group)
            for k, ids in zip(group, self._viterbi([words[k] for k in group])):
                out[k] = ids
        return out

    def _viterbi(self, words: list[str]) -> Iterator[tuple[int, ...]]:
        """``words`` longest first."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        size = np.array([len(w) for w in words])
        longest = int(size[0])
        symbols = np.zeros((longest + 1, len(words)), dtype=np.int64)
        column = np.repeat(np.arange(len(words)), size)
        row = np.arange(len(column)) - np.repeat(np.cumsum(size) - size, size)
        symbols[row, column] = self.symbol_of[np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)]
        best = np.full((longest + 1, len(words)), -np.inf)
        best[0] = 0.0
        piece, length = np.zeros(best.shape, dtype=np.int32), np.zeros(best.shape, dtype=np.int32)
        for i in range(longest):
            rows = np.arange(int(np.searchsorted(-size, -i)))  # words longer than i
            here, covered = best[i], np.zeros(len(rows), dtype=bool)
            state = np.zeros(len(rows), dtype=np.int64)
            for d in range(1, min(self.longest, longest - i) + 1):
                c = symbols[i + d - 1, rows]
                to = base[state] + c
                ok = (check[to] == state) & (c > 0)
                rows, state = rows[ok], to[ok]
                if not len(rows):
                    break
                ids = value[state]
                hit = ids >= 0
                r, ids = rows[hit], ids[hit]
                if d == 1:
                    covered[r] = True
                total = here[r] + self.score[ids]
                better = total > best[i + d, r]
                r = r[better]
                best[i + d, r], piece[i + d, r], length[i + d, r] = total[better], ids[better], d
            r = np.flatnonzero(~covered)
            total = here[r] + self.unknown_score
            better = total > best[i + 1, r]
            r = r[better]
            best[i + 1, r], piece[i + 1, r], length[i + 1, r] = total[better], self.unknown, 1
        # back from the ends, all words at once
        at, back = size.copy(), []
        rows = np.arange(len(words))
        while (at > 0).any():
            ids = np.where(at > 0, piece[at, rows], -1)
            back.append(ids)
            at = at - np.where(at > 0, length[at, rows], 0)
        table = np.array(back[::-1]).T  # a word's ids fill its row from the right
        ends = np.cumsum((table >= 0).sum(axis=1)).tolist()
        flat, odd = table[table >= 0].tolist(), (table == self.unknown).any(axis=1).tolist()
        for w, begin, end, unknown in zip(words, [0, *ends], ends, odd):
            ids = flat[begin:end]
            yield tuple(self._with_bytes(w, ids)) if unknown else tuple(ids)

    def _with_bytes(self, word: str, ids: list[int]) -> Iterator[int]:
        at = 0
        for i in ids:
            if i == self.unknown:
                yield from (self.byte_ids[b] for b in word[at].encode())
                at += 1
            else:
                yield i
                at += len(self.pieces[i])

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        met = set(chain.from_iterable(split))
        new = [w for w in met if w not in self.seen]
        if len(self.seen) + len(new) > REMEMBERED:  # of the old words, those met again stay
            self.seen = {w: self.seen[w] for w in met if w in self.seen}
        self.seen.update(zip(new, self.best_cuts(new)))
        return [list(chain.from_iterable(map(self.seen.__getitem__, words))) for words in split]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text.replace(SPACE, " ").removeprefix(" ")


@lru_cache(maxsize=2)
def codec(path: str | None = None) -> Codec:
    return Codec(tokenizer_path(path, MODEL))


def encode_texts(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids) of each row."""

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        own = codec(model)
        for b in batches:
            ids = own.encode([t or "" for t in b["text"]])
            yield {"doc_id": b["doc_id"], "ids": [None if t is None else i for t, i in zip(b["text"], ids)]}

    docs = docs.select("doc_id", "text")
    return map_columns(docs, work, {"doc_id": kind_of(docs, "doc_id"), "ids": "array<int>"}, ROWS)


def decode_texts(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, text) of each row of (doc_id, ids)."""

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        own = codec(model)
        for b in batches:
            yield {**b, "text": [None if i is None else own.decode(i) for i in b["ids"]]}

    encoded = encoded.select("doc_id", "ids")
    return map_columns(encoded, work, {"doc_id": kind_of(encoded, "doc_id"), "ids": "array<int>", "text": "string"}, ROWS)


def coded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of each row, the digest of the
    text decoded from the ids; encoding and decoding share one pass."""

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        own = codec(model)
        for b in batches:
            ids = own.encode([t or "" for t in b["text"]])
            ids = [None if t is None else i for t, i in zip(b["text"], ids)]
            yield {
                "doc_id": b["doc_id"],
                "n_tokens": [0 if i is None else len(i) for i in ids],
                "ids": ids,
                "decoded_sha256": [None if i is None else hashlib.sha256(own.decode(i).encode()).hexdigest() for i in ids],
            }

    docs = docs.select("doc_id", "text")
    schema = {"doc_id": kind_of(docs, "doc_id"), "n_tokens": "bigint", "ids": "array<int>", "decoded_sha256": "string"}
    return map_columns(docs, work, schema, ROWS)
