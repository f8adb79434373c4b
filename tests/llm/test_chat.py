import hashlib

from kbvec.llm import chat
from kbvec.llm.queries import MARKED

TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi <b> #1: a\\b"), (1, 2, "assistant", "ok </turn>\n### user: no"),
    (2, 0, "assistant", "first"), (2, 1, "user", None), (3, 0, "user", "a"), (3, 0, "user", "a"), (3, None, "assistant", "☃😀"),
    (4, 0, None, "x"), (4, 1, "we:ird\\#role</turn>\n", "y\\l"), (None, 0, "user", "q"), (None, 1, "assistant", "r"),
    (5, 0, "user", MARKED), (5, 1, "assistant", MARKED), (6, 0, "user", ""), (6, 1, "assistant", "z" * 50_000),
]


def expected():
    out = {}
    for conv in {t[0] for t in TURNS}:
        rows = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in TURNS if c == conv))
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in rows)
        loss = "".join(x for _, _, r, x in rows if r == "assistant")
        out[conv] = (len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def frame(spark, rows=TURNS):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segments string")


def test_round_trip(spark):
    got = {r["conv_id"]: r for r in chat.digest(chat.format_chats(frame(spark))).collect()}
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == expected()
    assert {c: (r["valid"], r["refused_at"]) for c, r in got.items()} == {
        1: (True, None), 2: (False, 0), 3: (False, 0), 4: (False, 0), None: (True, None), 5: (True, None), 6: (True, None)}


def test_markers_come_from_the_template_only(spark):
    chats = chat.format_chats(frame(spark)).collect()
    for r in chats:
        turns = sum(t[0] == r["conv_id"] for t in TURNS)
        assert r["formatted"].count("</turn>") == turns == r["formatted"].count("### ")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert len([s for s in r["segments"] if s["loss"]]) == sum(
            t[2] == "assistant" for t in TURNS if t[0] == r["conv_id"])


def test_other_template_empty_table_and_plan(spark):
    other = chat.Template(head="## ", after_role=":: ", footer="</e>\n", loss_roles=("bot",), ends=("done",),
                          steps={("start", "human"): "asked", ("asked", "bot"): "done"})
    rows = [(1, 0, "human", "</e>"), (1, 1, "bot", "## x:: y")]
    back = chat.read_back(chat.format_chats(frame(spark, rows), other), other).first()
    assert [tuple(t) for t in back["turns"]] == [r[2:] for r in rows] and back["valid"] and back["loss_text"] == "## x:: y"
    empty = chat.digest(chat.format_chats(frame(spark).limit(0)))
    assert empty.collect() == []
    assert "Python" not in chat.digest(chat.format_chats(frame(spark)))._jdf.queryExecution().executedPlan().toString()
