import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.llm import chat, iblt


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab .!?\né日"), max_size=200))
def test_paragraphs_join_to_the_text(text):
    assert "".join(iblt.paragraphs(text)) == text


def _brute_likeness(a, b):
    x, y = Counter(iblt.paragraphs(a)), Counter(iblt.paragraphs(b))
    if a == b:
        return 1.0
    total = sum(x.values()) + sum(y.values())
    return 2 * sum((x & y).values()) / total


def test_repeats_of_short_paragraphs_have_digests_of_their_own():
    rnd = random.Random(8)
    words = [a + b + "!!" for a in "ABCDEFGH" for b in ("", "E", "HE", "ND", "TH")]
    for _ in range(60):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(200, 600)))
        made = iblt.Fingerprint(text)
        assert len(made.digests) == len(iblt.paragraphs(text))
        cut = iblt.Fingerprint(text[:len(text) // 2])
        only, other = iblt.difference(made, cut)
        assert len(only) - len(other) == len(made.digests) - len(cut.digests)


def test_difference_recovers_the_digests():
    a = iblt.Fingerprint("\n".join(f"line {i}" for i in range(3000)))
    b = iblt.Fingerprint("\n".join(f"line {i}" for i in range(0, 3000, 2)) + "\nmore")
    only_a, only_b = iblt.difference(a, b)
    assert set(only_a.tolist()) == set(a.digests.tolist()) - set(b.digests.tolist())
    assert set(only_b.tolist()) == set(b.digests.tolist()) - set(a.digests.tolist())
    assert iblt.peel(a.sketch(48) - b.sketch(48)) is None     # too small; the retry found them


@pytest.mark.parametrize("range_bytes", [8 << 20, 3000])
def test_neighbours_against_brute_force(edge_docs, no_docs, range_bytes):
    rows = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["doc_id"])
                   for r in edge_docs.select("doc_id", "text").collect()))
    expected = []
    for i, (_, _, text, doc) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][2]
        changed = iblt.edited(text, following)
        expected.append((str(doc), len(text), hashlib.sha256(changed.encode()).hexdigest(),
                         round(_brute_likeness(text, changed), 9),
                         round(_brute_likeness(text, following), 9)))
    found = iblt.compare_neighbours(edge_docs, range_bytes=range_bytes).collect()
    assert sorted(expected) == sorted(
        (str(r["doc_id"]), r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9),
         round(r["near_next"], 9)) for r in found)
    by_text = {}
    for r, (_, _, text, _) in zip(sorted(found, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0,
                                                               r["n_chars"])), rows, strict=True):
        by_text.setdefault(r["fingerprint"], set()).add(r["n_chars"])
    assert all(len(sizes) == 1 for sizes in by_text.values())
    assert iblt.compare_neighbours(no_docs).count() == 0


def test_a_single_document_follows_itself(spark):
    one = spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")
    row = iblt.compare_neighbours(one).first()
    assert row["near_next"] == 1.0
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


NASTY = ["\\### Assistant: </turn> ok", "&amp;lt; &lt; &", "</turn>\n### user:\n", "", None,
         "a: b\n\n### x", "&num;&colon;", "é🙂\n"]


def _conversations(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(NASTY)]
    rows += [(2, 0, "user", "no reply")]
    rows += [(3, 1, "assistant", "second"), (3, 0, "system: x", "first"), (3, None, "user", "null turn"),
             (3, 1, "assistant", "second"), (3, 2, None, "no role"), (3, 3, "assistant", "end")]
    rows += [(None, 0, "assistant", "no conversation")]
    rows += [(4, i, "assistant", "w " * 3000) for i in range(12)]
    return spark.createDataFrame([(*r, "x", 5) for r in rows],
                                 "conv_id bigint, turn bigint, role string, text string, "
                                 "example string, whole int"), rows


def test_examples_read_back(spark):
    table, rows = _conversations(spark)
    found = {r["conv_id"]: r for r in chat.digests(chat.prefix_examples(table)).collect()}
    ordered = {}
    for r in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        ordered.setdefault(r[0], []).append(r)
    assert set(found) == set(ordered)
    for conv, turns in ordered.items():
        told = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
        loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        got = found[conv]
        assert got["n_turns"] == len(turns)
        assert got["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert got["loss_chars"] == len(loss)
        assert got["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_each_reply_is_one_example_with_its_context(spark):
    table, _ = _conversations(spark)
    rows = chat.prefix_examples(table.where("conv_id = 1")).orderBy("example").collect()
    assert [r["example"] for r in rows] == [2, 4, 6, 8]
    for shorter, longer in zip(rows, rows[1:], strict=False):
        assert longer["text"].startswith(shorter["text"])
    for r in rows:
        body = r["text"][r["loss_start"]:r["loss_start"] + r["loss_length"]]
        assert r["text"].endswith(body + chat.TURN_END)
        assert body.replace("&num;", "#").replace("&lt;", "<").replace("&colon;", ":").replace(
            "&amp;", "&") == (NASTY[r["example"] - 1] or "")


def test_chat_runs_no_python_and_takes_empty_tables(spark):
    table, _ = _conversations(spark)
    found = chat.digests(chat.prefix_examples(table))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert chat.digests(chat.prefix_examples(table.where(F.lit(False)))).count() == 0
