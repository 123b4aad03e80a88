"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and its loss
mask is the intersection of the sorted spans of assistant texts with the
sorted token spans, found by binary search.

The template marks turns as ``<|turn|>role<|body|>text<|end|>``.  The marks
are added to the tokenizer as atomic tokens, so no token reaches across a
mark.  Control strings inside roles and texts (the template's own and those of
common chat formats) are escaped by a backslash after their first character;
a string that already has backslashes there gets one more, so unescaping
restores every text exactly and no text can pose as a mark.

Rows are range-partitioned by (conv_id, turn), which spreads a conversation
of any length over tasks.  A task renders its part of a conversation in
segments of about ``segment_chars``, cut between turns; since marks are
atomic, the segments' tokens are those of the whole conversation.  A normal
conversation is one segment, or two at a partition's edge.

Cases: a null text or role is empty; a null conv_id is a conversation of its
own; turns that tie keep the order of role, then text (nulls first); repeated
rows are repeated turns; an empty assistant text has no token under the mask;
further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from daybook.llm.common import Columns, kind_of, map_columns
from daybook.llm.tokens import tokenizer_path

# Control strings of common chat formats, escaped like the template's marks.
COMMON_CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
LEARNED_ROLES = ("assistant",)
SEGMENT_CHARS = 200_000


@dataclass(frozen=True)
class Template:
    turn: str = "<|turn|>"
    body: str = "<|body|>"
    end: str = "<|end|>"
    controls: tuple[str, ...] = field(default=COMMON_CONTROLS)

    @cached_property
    def marks(self) -> tuple[str, str, str]:
        return self.turn, self.body, self.end

    @cached_property
    def _forms(self) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
        strings = sorted({*self.marks, *self.controls})
        firsts = sorted({s[0] for s in strings})
        if any("\\" in s for s in strings):
            raise ValueError("control strings must not hold a backslash")
        either = "|".join(f"{re.escape(f)}{{}}(?=" + "|".join(re.escape(s[1:]) for s in strings if s[0] == f) + ")" for f in firsts)
        turn = re.compile("(.*?)".join(map(re.escape, self.marks)), re.S)
        return re.compile(either.replace("{}", r"\\*")), re.compile(either.replace("{}", r"\\+")), turn

    def escape(self, text: str) -> str:
        return self._forms[0].sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._forms[1].sub(lambda m: m[0][:-1], text)

    def render(self, turns: list[tuple[str, str]], learned: tuple[str, ...]) -> tuple[str, list[tuple[int, int]]]:
        """The formatted text and the sorted spans of the learned turns' texts."""
        parts, spans, at = [], [], 0
        for role, text in turns:
            head, text = f"{self.turn}{self.escape(role)}{self.body}", self.escape(text)
            parts += [head, text, self.end]
            if role in learned and text:
                spans.append((at + len(head), at + len(head) + len(text)))
            at += len(head) + len(text) + len(self.end)
        return "".join(parts), spans

    def turns(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn, read back from formatted text."""
        return [(self.unescape(m[1]), self.unescape(m[2])) for m in self._forms[2].finditer(formatted)]


@lru_cache(maxsize=2)
def _tokenizer(path: str | None, marks: tuple[str, ...]):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_file(tokenizer_path(path))
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets cover leading spaces too
    tokenizer.encode_special_tokens = True
    tokenizer.add_tokens([AddedToken(m, normalized=False, special=False) for m in marks])
    return tokenizer


def mask_tokens(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for each token whose span meets a learned span; both sorted, found by binary search."""
    if not spans or not len(offsets):
        return np.zeros(len(offsets), dtype=np.int8)
    spans = np.array(spans)
    at = np.searchsorted(spans[:, 1], offsets[:, 0], side="right")  # first span that ends after the token begins
    inside = at < len(spans)
    return (inside & (spans[np.minimum(at, len(spans) - 1), 0] < offsets[:, 1])).astype(np.int8)


def format_conversations(
    rows: DataFrame,
    template: Template = Template(),
    learned: tuple[str, ...] = LEARNED_ROLES,
    tokenizer: str | None = None,
    segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """One row per segment: (conv_id, segment, formatted, ids, starts, ends, loss_mask).

    ``segment`` orders the segments of a conversation; starts and ends are
    code point offsets of the tokens in ``formatted``.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def encode(segments: list[tuple]) -> Columns:
        encoder = _tokenizer(tokenizer, template.marks)
        out: Columns = {k: [] for k in ("conv_id", "segment", "formatted", "ids", "starts", "ends", "loss_mask")}
        rendered = [template.render(turns, learned) for _, _, turns in segments]
        for (conv, no, _), (text, spans), e in zip(segments, rendered, encoder.encode_batch([t for t, _ in rendered], add_special_tokens=False)):
            offsets = np.array(e.offsets, dtype=np.int32).reshape(-1, 2)
            values = conv, no, text, e.ids, offsets[:, 0], offsets[:, 1], mask_tokens(offsets, spans)
            for k, v in zip(out, values):
                out[k].append(v)
        return out

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        first = TaskContext.get().partitionId() << 32
        ready, turns, size, waiting, conv = [], [], 0, 0, None
        for b in batches:
            for conv_id, role, text in zip(b["conv_id"], b["role"], b["text"]):
                if turns and (conv_id != conv or size >= segment_chars):
                    ready.append((conv, first, turns))
                    first, waiting, turns, size = first + 1, waiting + size, [], 0
                    if waiting >= segment_chars:
                        yield encode(ready)
                        ready, waiting = [], 0
                conv = conv_id
                turns.append((role or "", text or ""))
                size += len(turns[-1][1])
        if turns:
            ready.append((conv, first, turns))
        if ready:
            yield encode(ready)

    schema = {"conv_id": kind_of(rows, "conv_id"), "segment": "bigint", "formatted": "string", "ids": "array<int>", "starts": "array<int>", "ends": "array<int>", "loss_mask": "array<tinyint>"}
    return map_columns(rows, work, schema)


def learned_texts(formatted: str, starts: list[int], ends: list[int], mask: list[int], template: Template) -> list[str]:
    """The texts under the mask, one for each run of masked tokens, unescaped."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], np.asarray(mask, dtype=np.int8), [0]))))
    return [template.unescape(formatted[starts[a] : ends[b - 1]]) for a, b in zip(edge[::2], edge[1::2])]


def digests(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation: turn count and digests, read back from formatted segments.

    A digest runs over a conversation in order, so each conversation's texts
    meet in one task; they stream through it sorted by segment, and only the
    digest's state is held.
    """

    def read_back(batches: Iterator[Columns]) -> Iterator[Columns]:
        for b in batches:
            told, loss, n = [], [], []
            for text, starts, ends, mask in zip(b["formatted"], b["starts"], b["ends"], b["loss_mask"]):
                turns = template.turns(text)
                n.append(len(turns))
                told.append("".join(f"{role}\n{body}\n" for role, body in turns))
                loss.append("".join(learned_texts(text, starts, ends, mask, template)))
            yield {"conv_id": b["conv_id"], "segment": b["segment"], "n": n, "chars": [len(t) for t in b["formatted"]], "told": told, "loss": loss}

    kind = kind_of(segments, "conv_id")
    parts = map_columns(segments, read_back, {"conv_id": kind, "segment": "bigint", "n": "bigint", "chars": "bigint", "told": "string", "loss": "string"})
    sorted_parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "segment")

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        state: list | None = None  # conv_id, turns, digest, loss chars, loss digest, chars

        def done(out: Columns) -> None:
            for k, v in zip(names, (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])):
                out[k].append(v)

        for b in batches:
            out: Columns = {k: [] for k in names}
            for conv, n, chars, told, loss in zip(b["conv_id"], b["n"], b["chars"], b["told"], b["loss"]):
                if state is None or state[0] != conv:
                    if state is not None:
                        done(out)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += n
                state[2].update(told.encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += chars
            yield out
        if state is not None:
            out = {k: [] for k in names}
            done(out)
            yield out

    return map_columns(sorted_parts, run, {"conv_id": kind, "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"})
