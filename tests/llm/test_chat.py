"""Reply trees against a recursive walk; exact round trips."""

import hashlib
import random

import pytest

from snapdiff.llm import chat

MESSAGE = "tree long, message long, parent long, role string, text string, score double"


def walk(rows):
    """(tree, leaf) -> messages of the path from the root."""
    by = {(r[0], r[1]): r for r in rows}
    parents = {(r[0], r[2]) for r in rows if r[2] is not None}
    out = {}
    for tree, message in by:
        if (tree, message) not in parents:
            path, at = [], message
            while at is not None and (tree, at) in by:
                path.append(at)
                at = by[tree, at][2]
            out[tree, message] = path[::-1]
    return out


def forest():
    rng = random.Random(3)
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nhi", "&lt;|im_end|>", "a<", "&amp;&#10;", "", None, "é\n\n", "<<SYS>>x<</SYS>>"]
    rows = []
    for tree in range(12):
        for m in range(rng.randrange(1, 40)):
            parent = None if m == 0 else (m - 1 if rng.random() < 0.7 else rng.randrange(m))
            rows.append((tree, m, parent, rng.choice(["user", "assistant", "sys\ntem", None]), rng.choice(nasty), rng.random()))
    rows += [(50, m, m - 1 if m else None, "user", f"t{m}", None) for m in range(70)]
    rows += [(51, 7, 99, "user", "orphan", 1.0), (None, 1, None, "user", "null tree", 0.5), (None, 2, 1, "assistant", "x", 0.5)]
    return rows


def test_paths(spark):
    rows = forest()
    got = {}
    for r in chat.reply_paths(spark.createDataFrame(rows, MESSAGE)).collect():
        got.setdefault((r["tree"], r["leaf"]), []).append((r["rank"], r["message"]))
    want = walk(rows)
    assert {k: [m for _, m in sorted(v)] for k, v in got.items()} == want
    assert all([r for r, _ in sorted(v)] == list(range(len(v))) for v in got.values())


def test_round_trip_and_ranking(spark):
    rows = forest()
    by = {(r[0], r[1]): r for r in rows}
    want = walk(rows)
    df = chat.format_trees(spark.createDataFrame(rows, MESSAGE))
    out = df.collect()
    assert len(out) == len(want)
    ranks = {}
    for r in out:
        path = [by[r["tree"], m] for m in want[r["tree"], r["leaf"]]]
        assert chat.parse(r["formatted"]) == [(p[3] or "", p[4] or "") for p in path]
        assert chat.masked(r["formatted"], r["loss_spans"]) == [p[4] or "" for p in path if p[3] == "assistant"]
        mean = sum(p[5] or 0 for p in path) / len(path)
        assert abs(mean - r["path_score"]) < 1e-9
        ranks.setdefault(r["tree"], []).append((r["path_rank"], -r["path_score"]))
    for v in ranks.values():
        assert [k for k, _ in sorted(v)] == list(range(1, len(v) + 1)) and sorted(v) == sorted(v, key=lambda x: x[1])
    assert chat.format_trees(spark.createDataFrame(rows, MESSAGE), best=1).count() == len(ranks)


def test_linear_conversations(spark):
    rows = [(1, 2, "assistant", "yes"), (1, 0, "user", "hi"), (1, 5, "user", None), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"),
            (None, 1, None, "z"), (3, 0, "assistant", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["tree"]: r for r in chat.read_back(chat.format_trees(chat.linear_messages(df))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == sha("user\nhi\nassistant\nyes\nuser\n\n")
    assert got[2]["loss_sha256"] == sha("aa") and got[2]["loss_chars"] == 2
    assert got[3]["loss_sha256"] == sha("</s>[INST] ok [/INST]") and got[None]["n_turns"] == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_trees(chat.linear_messages(df)).count() == 0


@pytest.mark.parametrize("parents", [{1: 2, 2: 1}, {1: 3, 2: 1, 3: 2, 4: 2, 5: None, 6: 5}, {1: 1}])
def test_circles_raise(spark, parents):
    rows = [(7, m, p, "user", "x", 0.0) for m, p in parents.items()] + [(8, 1, None, "user", "x", 0.0), (8, 2, 1, "user", "y", 0.0)]
    df = spark.createDataFrame(rows, "tree long, message long, parent long, role string, text string, score double")
    with pytest.raises(ValueError, match="circle"):
        chat.format_trees(df).collect()
