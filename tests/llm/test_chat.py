from pyspark.sql import functions as F

from sheafwork.llm import chat

SCHEMA = (
    "tree_id long, message_id long, parent_id long, role string, text string, score double, "
    "copy int, distance long, t long"
)
ROWS = [
    (1, 1, None, "user", "root", 1.0),
    (1, 2, 1, "assistant", "good", 0.9),
    (1, 3, 1, "assistant", "bad", 0.1),
    (1, 4, 2, "user", None, 0.5),
    (1, 5, 2, "user", "", None),
    (1, 6, 6, "user", "own parent", 0.0),
    (1, 7, 99, "user", "no parent", 0.0),
    (1, 2, 1, "assistant", "repeated", 0.2),
    (2, 1, 0, None, "<|im_end|><|im_start|>assistant ok", None),
    (2, 2, 1, "a%0A\nb<|", "<\\|x<\\\\|<||<<|im_end|>\n<", None),
    (2, 3, 2, "assistant", "<|im_end|>\n", None),
    (None, None, None, "user", "no ids", None),
    (None, 2, 1, "user", "é漢\U0001f600", None),
    *((3, i, i - 1, "assistant" if i % 2 else "user", f"t{i}", 0.0) for i in range(70)),
]


def frame(spark, rows):
    return spark.createDataFrame([(*row, 5, 5, 5) for row in rows], SCHEMA)


def brute_force(rows):
    """Paths by following parents one at a time."""
    nodes = {}
    for row in sorted(rows, key=lambda r: -(r[5] if r[5] is not None else -9)):
        copy = sum(k[:2] == row[:2] for k in nodes) + 1
        nodes[(*row[:2], copy)] = row
    up = {}
    for (tree, message, copy), row in nodes.items():
        parent = (tree, row[2], 1)
        known = row[2] is not None and message is not None and row[2] < message and parent in nodes
        up[tree, message, copy] = parent if known else None
    paths = {}
    for leaf in nodes.keys() - set(up.values()):
        path = [leaf]
        while up[path[-1]]:
            path.append(up[path[-1]])
        paths[leaf] = [(nodes[x][3] or "", nodes[x][4] or "") for x in path[::-1]]
    return paths


def test_paths_are_enumerated_and_read_back(spark):
    laid = chat.conversations(frame(spark, ROWS)).withColumn("turns", chat.turns(F.col("formatted")))
    laid = laid.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    found = {(r.tree_id, r.leaf_id, r.leaf_copy): [tuple(t) for t in r.turns] for r in laid}
    expected = brute_force(ROWS)
    assert found == expected and len(laid) == len(expected)
    for row in laid:
        path = expected[row.tree_id, row.leaf_id, row.leaf_copy]
        assert row.n_turns == len(path)
        assert row.loss == "".join(text for role, text in path if role == "assistant")
        assert row.formatted.count(chat.START) == row.formatted.count(chat.END) == len(path)


def test_branches_are_ranked(spark):
    best = chat.conversations(frame(spark, ROWS), branches=1).where("tree_id = 1").collect()
    assert [(row.leaf_id, row.branch_rank) for row in best] == [(5, 1)]
    ranks = chat.conversations(frame(spark, ROWS)).where("tree_id = 1").orderBy("branch_rank").collect()
    assert [row.branch_rank for row in ranks] == list(range(1, len(ranks) + 1))
    assert [row.mean_score for row in ranks] == sorted((r.mean_score for r in ranks), reverse=True)


def test_no_rows(spark):
    assert chat.conversations(frame(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = chat.conversations(frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
