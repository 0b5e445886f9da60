from collections import Counter

import pytest

from wardbook.llm.common import LOWER, UPPER, workspace
from wardbook.llm.line_runs import LineRuns, dedup_lines, keyed_lines

SPACES = " \t\n\x0b\x0c\r"


def plain(rows):
    last, first = 2**63 - 1, {}
    key = lambda line: line.strip(SPACES).translate(str.maketrans(UPPER, LOWER))
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                i_ = last if i is None else i
                first[key(line)] = min(first.get(key(line), last), i_)
    out = Counter()
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(key(x), last) >= (last if i is None else i)]
        out[(i, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    return out


@pytest.mark.parametrize("batches,fan_in", [(1, 2), (3, 2), (7, 3)])
def test_equals_a_plain_version(spark, odd, batches, fan_in):
    extra = spark.createDataFrame(
        [(20 + i % 9, f"line number {i % 7} of many\n\nshort\n  Line NUMBER {i % 5} of many ") for i in range(40)],
        "doc_id long, text string",
    )
    docs = odd.select("doc_id", "text").unionByName(extra)
    got = dedup_lines(docs, batches=batches, fan_in=fan_in).collect()
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == plain([tuple(r) for r in docs.collect()])


def test_runs_are_levelled_and_disjoint(spark, odd):
    runs = LineRuns(workspace(spark), fan_in=2)
    for i in range(7):
        lines = spark.createDataFrame([(10 * i + j, f"a line of batch {i - j % 2}, row {j}") for j in range(5)], "doc_id long, text string")
        runs.add(keyed_lines(lines, "doc_id", "text", 10))
        assert all(len(level) < 2 for level in runs.levels)
    known = runs.known()
    assert known.count() == known.select("h").distinct().count()
    assert len(runs.levels) == 3


def test_columns_stay(spark, odd):
    got = dedup_lines(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_dropped"] and got.count() == odd.count()
    assert dedup_lines(odd.limit(0)).count() == 0
    clash = spark.createDataFrame([(1, "x", 7)], "doc_id long, text string, n_lines long")
    assert dedup_lines(clash).columns == ["doc_id", "text", "n_lines", "n_dropped"]
