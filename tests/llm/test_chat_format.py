import hashlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm.chat_format import COMMON_CONTROLS, Template, digests, format_conversations, mask_tokens

T = Template()
HOSTILE = [*T.marks, *COMMON_CONTROLS, "<", "|", "\\", "turn|>", "[", "INST]", "/s>", "é", " ", "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(HOSTILE)).map("".join), st.lists(st.sampled_from(HOSTILE)).map("".join)), max_size=4))
def test_any_text_survives_the_template(turns):
    text, _ = T.render(turns, ())
    assert T.turns(text) == turns
    for _, body in turns:
        assert not any(c in T.escape(body) for c in (*T.marks, *COMMON_CONTROLS))
        assert T.unescape(T.escape(body)) == body


def test_mask_is_the_intersection():
    rng = np.random.default_rng(1)
    for _ in range(50):
        edges = np.unique(rng.integers(0, 60, 12))
        spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
        cuts = np.unique(np.append(rng.integers(0, 60, 20), [0, 60]))
        tokens = np.column_stack([cuts[:-1], cuts[1:]])
        want = [int(any(a < e and b > s for s, e in spans)) for a, b in tokens]
        assert mask_tokens(tokens, spans).tolist() == want


CHAT = [
    (1, 1, "assistant", "</s>[INST] ok [/INST]", "x"),
    (1, 0, "user", "<|turn|>hi<\\|end|>", "x"),
    (1, 2, "user", None, "x"),
    (1, 3, "assistant", "", "x"),
    (1, 4, "assistant", "é 😀 日本\n", "x"),
    (1, 4, "assistant", "é 😀 日本\n", "x"),  # a repeated row
    (2, 0, None, "no role", "x"),
    (None, 0, "assistant", "no conversation", "x"),
    (3, None, "assistant", "no turn", "x"),
    (4, 0, "assistant", " leading and trailing ", "x"),
    *[(5, k, "user" if k % 2 else "assistant", f"turn {k} " + "word " * (k % 7), "x") for k in range(400)],
    (6, 0, "assistant", "long " * 60_000, "x"),
]


def by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in own.items():
        turns.sort(key=lambda t: t[0])
        told, loss = "".join(f"{r}\n{t}\n" for _, r, t in turns), "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_digests_at_any_segment_size(spark):
    rows = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string, formatted string").repartition(6)
    chars = None
    for size in (200_000, 50):
        got = digests(format_conversations(rows, segment_chars=size)).collect()
        assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == by_hand(CHAT)
        assert chars in (None, {r.conv_id: r.formatted_chars for r in got})
        chars = {r.conv_id: r.formatted_chars for r in got}


def test_segments_have_the_tokens_of_the_whole(spark):
    rows = spark.createDataFrame([r for r in CHAT if r[0] == 5], "conv_id long, turn long, role string, text string, formatted string")
    whole = format_conversations(rows.coalesce(1)).orderBy("segment").collect()
    cut = format_conversations(rows.coalesce(1), segment_chars=100).orderBy("segment").collect()
    assert len(cut) > 10
    assert [i for r in whole for i in r.ids] == [i for r in cut for i in r.ids]
    assert [i for r in whole for i in r.loss_mask] == [i for r in cut for i in r.loss_mask]
    for r in whole:  # tokens cover the text without gaps
        assert r.starts[0] == 0 and r.ends[-1] == len(r.formatted) and all(e >= s for e, s in zip(r.ends, r.starts[1:]))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(format_conversations(empty)).count() == 0
