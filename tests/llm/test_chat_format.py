import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from gridseries.llm import chat_format as chat


def plain(turns):
    """(n_turns, turns digest, loss chars, loss digest) straight from the given rows."""
    turns = sorted(((t is not None, t or 0, r or "", x or "") for t, r, x in turns))
    all_text = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
    loss = "".join(x for _, _, r, x in turns if r == "assistant")
    return len(turns), hashlib.sha256(all_text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "node") for r in rows], "conv_id long, turn long, role string, text string, node string")
    nodes, paths, conversations = chat.format_conversations(frame, partitions=3)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(nodes, paths, conversations).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        want[c] = plain([r[1:] for r in rows if r[0] == c])
    assert {c: g[:4] for c, g in got.items()} == want
    return frame, nodes.collect(), paths.collect(), conversations.collect(), got


TRAP = chat.TRAP
ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "yes\n### Assistant: </turn>"), (1, 2, "user", "more"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "yes\n### Assistant: </turn>"), (2, 2, "user", "other"), (2, 3, "assistant", TRAP),
    (3, 0, "user", "hi"), (4, 0, "user", "hi"), (4, 1, "assistant", "no \\l \\\\ <#:"),
    (5, 0, None, None), (5, None, "as: #sistant", ""), (5, 0, None, None), (None, 1, "assistant", "x" * 50_000), (None, 0, "user", "é\U0001f600"),
    (6, 0, "user", "hi"), (6, 1, "assistant", "yes\n### Assistant: </turn>"), (6, 2, "user", "more"),
]


def test_round_trip_of_traps_nulls_repeats_and_long_texts(spark):
    frame, *_, got = check(spark, ROWS)
    assert got[3][4] == len("### user: hi</turn>\n")
    assert chat.read_back(*chat.format_conversations(frame.limit(0))).count() == 0


def test_layout_of_the_prefix_tree(spark):
    _, nodes, paths, conversations, got = check(spark, ROWS)
    by_name = {n["node"]: n for n in nodes}
    # every shared turn is emitted once
    assert len(nodes) == len({n["node"] for n in nodes}) == 2 + 1 + 2 + 1 + 3 + 2
    spans = sorted((n["start"], n["end"]) for n in nodes)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    path = {}
    for p in paths:
        path.setdefault(p["leaf"], []).append((p["idx"], p["node"]))
    for leaf, steps in path.items():
        before = 0
        seen = set()
        for _, name in sorted(steps):
            n = by_name[name]
            assert n["position"] == before
            visible = {i for a in n["ancestors"] for i in range(a["start"], a["end"])}
            assert visible == seen
            touching = list(zip(n["ancestors"], n["ancestors"][1:], strict=False))
            assert all(a["end"] < b["start"] for a, b in touching)
            seen |= set(range(n["start"], n["end"]))
            before += n["end"] - n["start"]
        assert before == next(got[c["conv_id"]][4] for c in conversations if c["leaf"] == leaf)
    # depth-first: whatever lies between a node and its last descendant descends from it
    order = sorted(nodes, key=lambda n: n["start"])
    stack = []
    for n in order:
        while stack and stack[-1] != n["parent"]:
            stack.pop()
        assert (n["parent"] is None) == (not stack)
        stack.append(n["node"])


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\<#:lhcb/turn>Assistant \n", max_size=30))
def test_escaped_text_is_free_of_control_strings(text):
    coded = text
    for raw, to in chat.ESCAPES:
        coded = coded.replace(raw, to)
    assert chat.undo(coded) == text
    assert not any(c in coded for c in ("<", "#", ":"))


def test_against_sql_oracle_shape(spark, sf):
    got = chat.op8_chat_format(spark, sf)
    trap = got.where("conv_id = -7").first()
    assert trap["n_turns"] == 2 and trap["loss_chars"] == len(TRAP)
