"""Line templates against SQL over the whole table and a plain walk."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import line_templates as lt

SF = "/root/testdata/sf0.001"


def test_whole_table_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.execute(lt.OP1_SQL).fetchall())
    got = sorted(tuple(r) for r in lt.op1_line_template_dedup(spark, SF).collect())
    assert got == want
    assert 0 < sum(r[2] for r in got) < sum(r[1] for r in got)


def plain(docs):
    def templates(line):
        words = [("<*>" if any(ch in "0123456789" for ch in w) else w) for w in line.split()]
        n, width = len(words), -(-(len(words) - lt.LEAD) // lt.BANDS)
        if n < lt.LEAST_WORDS:
            return [(n, *words)] if n else []
        return [(n, j, *words[: lt.LEAD + j * width], "|", *words[lt.LEAD + (j + 1) * width :]) for j in range(lt.BANDS) if n > lt.LEAD + j * width]

    owner = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            for k in templates(line):
                owner[k] = min(owner.get(k, 10**9), d if d is not None else 10**8)
    out = []
    for d, t in docs:
        lines = t.split("\n") if t is not None else []
        kept = [x for x in lines if not any(owner[k] < (d if d is not None else 10**8) for k in templates(x))]
        out.append((d, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)))
    return sorted(out, key=str)


def test_templates_nulls_ties_and_clashing_columns(spark):
    line = "user alice signed in from {} at noon with key {} today"
    docs = [(1, line.format("10.0.0.1", "a1") + "\nOwn words stay here for document one alone"), (2, line.format("192.168.0.9", "zz9") + "\nshort one"),
            (3, "\n".join([line.format("x7", "b2")] * 3) + "\n\nshort one"), (4, None), (5, ""), (6, "short one\nalpha beta gamma delta red five six"),
            (7, "alpha beta gamma delta blue five six\nalpha beta gamma other other other six"), (None, "alpha beta gamma delta green five six"),
            (8, " ".join(f"w{i}" for i in range(20000))), (8, " ".join(f"w{i}" for i in range(20000))), (8, "another text of the same id")]
    df = spark.createDataFrame([(*d, "y", 2) for d in docs], "doc_id long, text string, a string, line int").toDF("doc_id", "text", "TEXT", "line")
    got = sorted((tuple(r) for r in lt.drop_recurring_lines(df).collect()), key=str)
    assert got == plain(docs)
    dropped = {r[0]: r[2] for r in got}
    assert dropped[1] == 0 and dropped[2] == 1 and dropped[3] == 4 and dropped[6] == 1 and dropped[7] == 1 and dropped[None] == 1
    assert lt.drop_recurring_lines(df.where(F.lit(False))).collect() == []
    with pytest.raises(ValueError):
        lt.drop_recurring_lines(df, lead=5)
