import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldline.llm import chat as C
from fieldline.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("line, role", [("User: hi", 1), ("  human : x", 1), ("### Assistant", 2), ("### Assistants", -1), ("**A:** b", 2),
                                        ("[SYSTEM] s", 0), ("<|tool|> r", 3), ("A plain line", -1), ("userland: x", -1), ("", -1)])
def test_marker(line, role):
    assert C.marker(line)[0] == role + 1


def random_model(seed=1):
    rng = np.random.default_rng(seed)
    counts = {("step", a, b): rng.integers(0, 9) for a in range(C.N_STATES) for b in range(C.N_STATES)}
    counts |= {(str(k), s, v): rng.integers(0, 9) for k, n in enumerate(C.FEATURES) for s in range(C.N_STATES) for v in range(n)}
    return C.role_model(counts | {("start", 0, s): 2 for s in range(0, C.N_STATES, 2)})


def score(model, x, path):
    s = model.scores(x)
    return model.start[path[0]] + s[0, path[0]] + sum(model.step[a, b] + s[t, b] for t, (a, b) in enumerate(zip(path, path[1:]), 1))


def test_viterbi_equals_enumeration_and_chains_compose():
    model, rng = random_model(), np.random.default_rng(2)
    x = np.stack([rng.integers(0, n, 5) for n in C.FEATURES], axis=1)
    best = max(score(model, x, p) for p in itertools.product(range(C.N_STATES), repeat=5))
    assert score(model, x, model.viterbi(x)) == pytest.approx(best)
    x = np.stack([rng.integers(0, n, 60) for n in C.FEATURES], axis=1)
    whole = model.chain(x, True)
    parts = (model.chain(x[:23], True)[:, :, None] + model.chain(x[23:], False)[None]).max(axis=1)
    assert np.allclose(whole[0], parts[0])
    assert score(model, x, model.viterbi(x)) == pytest.approx(whole[0].max())


def test_roles_are_recovered(spark):
    table = read_table(spark, SF, "conversations")
    lines = C.transcript_lines(table)
    model = C.fit_roles(lines.where("pmod(conv_id, 5) != 0"))
    got = {(r.conv_id, r.turn_line): r for r in C.format_chat(lines, model).collect()}
    starts = {}  # the line on which each turn of a conversation starts, from the labels
    for r in sorted(lines.where("state % 2 = 0").collect(), key=lambda r: (r.conv_id, r.line_no)):
        starts.setdefault(r.conv_id, []).append(r.line_no)
    rows = sorted(table.collect(), key=lambda r: (r.conv_id, r.turn))
    assert sum(map(len, starts.values())) == len(rows)
    places = [(r, (c, no)) for c, group in itertools.groupby(rows, key=lambda r: r.conv_id) for r, no in zip(group, starts[c])]
    held = [(r, k) for r, k in places if r.conv_id % 5 == 0]
    assert np.mean([k in got and got[k].role == r.role for r, k in held]) > 0.97
    assert np.mean([got[k].text == r.text.strip() for r, k in held if k in got]) > 0.95
    one = got[held[0][1]]
    assert one.rendered == f"<|{one.role}|>\n{one.text}\n<|end|>\n"


def test_lines_are_numbered_through_a_conversation(spark, monkeypatch):
    rows = [(1, None, "user", "alpha one\nbeta one"), (1, None, "assistant", "alpha two\nbeta two"), (1, 3, "user", "early"),
            (2, 0, "user", "q1"), (2, 0, "assistant", "a1"), (2, 0, "user", "q1"), (2, 1, "robot", None), (None, 0, "user", "lone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for most in (2, 100_000):
        monkeypatch.setattr(C, "NUMBERED_ROWS", most)
        lines = C.transcript_lines(df).collect()
        by = {}
        for r in sorted(lines, key=lambda r: (r.conv_id, r.line_no)):
            by.setdefault(r.conv_id, []).append(r)
        assert all([r.line_no for r in g] == list(range(len(g))) for g in by.values())
        roles = lambda c: [C.ROLES[r.state // 2] for r in by[c] if r.state % 2 == 0]
        assert roles(1) == ["user", "user", "assistant"] and roles(2) == ["user", "user", "assistant", "user"]
        text = "\n".join(r.line for r in by[1])
        assert text.index("early") < text.index("alpha one") < text.index("beta one") < text.index("alpha two") < text.index("beta two")
        assert len(by) == 3 and max(by) >= 1 << 62


def test_chunks_decode_like_whole_transcripts(spark):
    lines = C.transcript_lines(read_table(spark, SF, "conversations"))
    # seven long transcripts, one number per line
    rows = sorted((r.conv_id % 7, r.conv_id, r.line_no, r.line, r.state) for r in lines.collect())
    flat = spark.createDataFrame([(c, 3 * i, x, s) for i, (c, _, _, x, s) in enumerate(rows)], "conv_id long, line_no long, line string, state int")
    model = C.fit_roles(flat)
    for chunk in (100, 291):  # a cut through a transcript changes no count
        small = C.fit_roles(flat, chunk)
        assert np.array_equal(small.step, model.step) and np.array_equal(small.start, model.start)
        assert all(np.array_equal(a, b) for a, b in zip(small.emit, model.emit))
    whole = {}
    for c, group in itertools.groupby(enumerate(rows), key=lambda r: r[1][0]):
        at = list(group)
        path = model.viterbi(C.encode([x for _, (_, _, _, x, _) in at]))
        whole |= {3 * i: int(s) // 2 for (i, _), s in zip(at, path)}
    for chunk in (1 << 40, 291):
        got = {r.line_no: r.role for r in C.decode_lines(flat, model, chunk).select("line_no", "role").collect()}
        assert got == whole
    turns = [C.format_chat(flat, model, chunk) for chunk in (1 << 40, 291)]
    assert sorted(map(tuple, turns[0].collect())) == sorted(map(tuple, turns[1].collect()))


def test_groups_that_span_batches_stay_whole():
    import pandas as pd
    seen = []
    run = C._by_chunk(lambda g: seen.append(list(g["v"])) or [(len(g["v"]),)], "n int")
    frame = pd.DataFrame({"conv_id": [1] * 5 + [2] * 3, "chunk": [0, 0, 0, 1, 1, 1, 1, 2], "v": range(8)})
    for step in (1, 2, 3, 8):
        seen.clear()
        out = [n for part in run(iter([frame.iloc[i:i + step] for i in range(0, 8, step)])) for n in part["n"]]
        assert seen == [[0, 1, 2], [3, 4], [5, 6], [7]] and out == [3, 2, 2, 1]


def test_nulls_repeats_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string, chunk int"
    rows = [(1, 0, "user", "Hello there?", 1), (1, 1, "assistant", "Hi.\n\nMore.", 1), (1, 1, "assistant", "Hi.\n\nMore.", 1), (2, 0, None, None, 1),
            (None, None, "user", "x", 1), (2, None, "robot", "", 1)]
    lines = C.transcript_lines(spark.createDataFrame(rows, schema))
    model = C.fit_roles(lines)
    out = C.format_chat(lines, model).collect()
    assert {r.conv_id for r in out} >= {1, 2} and all(r.role in C.ROLES for r in out)
    empty = lines.limit(0)
    assert C.format_chat(empty, C.fit_roles(empty)).count() == 0
    raw = spark.createDataFrame([(1, 0, None, "x"), (1, 1, "User: a", "x"), (1, 1, "User: a", "x")], "conv_id long, line_no long, line string, role string")
    assert C.format_chat(raw, model).count() >= 1
