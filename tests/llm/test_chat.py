"""Exact round trips of turns and loss texts."""

import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from foliomill.llm import chat, queries
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
T = chat.Template()
signs = st.lists(st.sampled_from([*T.marks, *T.reserved, "\\", "<", "|", "<|", "|>", "a", " ", "\n", "é", "[", "/INST]", "<\\|end|>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(signs)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    escaped = T.escape(text)
    assert T.unescape(escaped) == text
    assert not any(c in escaped for c in (*T.marks, *T.reserved))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(signs, signs), min_size=1, max_size=5))
def test_render_and_parse(turns):
    formatted, spans = T.render(turns)
    assert T.parse(formatted) == turns
    assert [T.unescape(formatted[a:b]) for a, b in spans] == [t for _, t in turns]


def test_plain_text_stays_as_it_is():
    assert T.escape("C:\\x <b> [i] \\n </p>") == "C:\\x <b> [i] \\n </p>"


def test_mask_equals_brute_force():
    draw = np.random.default_rng(0)
    for _ in range(50):
        cuts = np.unique(draw.integers(0, 60, 20))
        starts, ends = cuts[:-1], cuts[1:]
        edges = np.unique(draw.choice(cuts, 6))
        spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]  # noqa: B905
        want = [any(a <= s and e <= b for a, b in spans) for s, e in zip(starts, ends, strict=True)]
        assert chat.loss_mask(starts, ends, spans).tolist() == want


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(rows):
    by = defaultdict(list)
    for k, r in enumerate(rows):
        by[("alone", k) if r[0] is None else r[0]].append(r)
    out = []
    for own in by.values():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        out.append((own[0][0], len(own), sha(whole), len(loss), sha(loss)))
    return sorted(map(str, out))


ROWS = [
    (1, 1, "assistant", " leading space, é\U0001f600 </s>"), (1, 0, "user", "hi\n"), (1, 2, "assistant", ""), (1, 3, "assistant", None), (1, 4, None, "x"),
    (2, 0, "user", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "</s>[INST] ok [/INST]"), (None, 0, "assistant", "a"), (None, 0, "assistant", "b"),
    (3, None, "assistant", "<|end|> <\\|end|>"), (3, 0, "assistant", "w " * 60000), (4, 0, "user", "only"), (5, 0, "assistant", "r"), (5, 0, "assistant", "r"),
    (6, 0, "assi\nstant<|body|>", "日本語 テキスト"), (6, 1, "assistant", "日本語 \U0001f468‍\U0001f469‍\U0001f467 ̈x"),
]


def test_conversations(spark):
    frame = spark.createDataFrame([(*r, "z", 0) for r in ROWS], "conv_id long, turn long, role string, text string, key string, ids int").repartition(4)
    chats = chat.format_chats(frame, PATH)
    got = chat.digests(chats).collect()
    assert sorted(str((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)) for r in got) == expected(ROWS)
    tokenizer = Tokenizer.from_file(PATH)
    for r in chats.collect():
        ids = [i for i in r.ids if i < tokenizer.get_vocab_size()]
        text = r.formatted
        for m in T.marks:
            text = text.replace(m, "")
        assert tokenizer.decode(ids) == text
        assert len(r.ids) == len(r.starts) == len(r.ends) == len(r.loss)
    assert chat.digests(chat.format_chats(frame.limit(0), PATH)).count() == 0


def test_table_and_the_added_conversation(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = queries.QUERIES["op6_chat_format"](spark, sf).collect()
    assert sorted(str((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)) for r in got) == expected(rows)
