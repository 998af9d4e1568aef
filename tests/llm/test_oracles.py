"""Named queries that SQL can express equal their oracle, row for row."""

import duckdb
import pytest

from tests.parity import compare, connect
from wardstone.llm import linerules
from wardstone.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    problems, rows, _ = compare(spark, connect(FOLDER), QUERIES[name], ORACLES[name], FOLDER)
    assert problems == [] and rows > 0


def test_names():
    import __spark_entry__ as entry

    named = entry.queries()
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in named if n.startswith("op") and n in QUERIES}
    assert "pipeline" in named


_LONG = " ".join(f"v{i}" for i in range(30)) + " "
_GOOD = "This is a plain sentence of a dozen words that says a thing. "
_LINES = {  # each line, were it most of a document, decides by one rule
    "navigation": "home | news | sport | money | more",
    "wide separators": "home · news · sport · money · more",
    "opening bullet": "· one plain item without any further sign",
    "closing quote": "he said « well then » and went home",
    "chevrons": "start » wares » tools » saws",
    "symbols": "## $$ %% && ** << >> ##",
    "bangs": "buy now!!! cheap!!! today!!! only!!!",
    "shouting": "THIS LINE IS ALL IN CAPITAL LETTERS AND LONG",
    "again": "spam spam spam spam spam spam spam spam",
    "boilerplate": "please read our Privacy Policy before you go on",
    "no sentence": _LONG,
    "wide stop": _LONG + "end…",
    "closed stop": _LONG + 'end.)" more',
    "inner dot": _LONG + "a.b",
    "full stop": _LONG + "终。more",
    "thai": _LONG + "ไทย",
    "short": "a short line without any end",
}


def _documents():
    rows = [(0, None), (1, ""), (2, _GOOD * 10)]
    for i, line in enumerate(_LINES.values()):
        # other words each time, so that no line repeats
        many = "\n".join(line.replace("v3 ", f"v3k{k} ") if "v3 " in line else f"{line} {k}" for k in range(60))
        rows += [(10 + 2 * i, many), (11 + 2 * i, _GOOD + "\n" + many)]
    return rows


def test_line_rules_sql_states_every_rule(spark, tmp_path):
    df = spark.createDataFrame(_documents(), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    problems, rows, _ = compare(spark, con, QUERIES["op7_line_rules"], ORACLES["op7_line_rules"], str(tmp_path))
    assert problems == [] and rows == len(_documents())
    lost = {r["doc_id"]: r["lost_chars"] > 0.5 * r["word_chars"] for r in linerules.clean(df).collect()}
    verdict = {name: lost[10 + 2 * i] for i, name in enumerate(_LINES)}
    stay = {"opening bullet", "closing quote", "wide stop", "closed stop", "full stop", "thai", "short"}
    assert {name for name, failed in verdict.items() if not failed} == stay
