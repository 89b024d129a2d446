"""Lines of one to four words: a small table by hand, and what leaves the pipeline's stages."""

import corpus_pipeline as cp
from tarnwork.llm import line_templates as lt

SF = "/root/testdata/sf0.001"
DOCS = [(1, "All rights reserved.\nalpha beta gamma delta red five six\n\nPage 3"), (2, "All  rights reserved.\nrights reserved.\n\nPage 41"),
        (3, "all rights reserved.\nalpha beta gamma delta blue five six"), (4, None), (5, ""), (6, "Menu\nMenu\n \t"), (None, "Menu\nrights reserved.\nlast")]


def test_short_lines_that_recur_go(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lt.drop_recurring_lines(df).collect()}
    assert got == dict(DOCS) | {2: "rights reserved.\n", 3: "all rights reserved.", None: "last"}


def test_no_line_recurs_before_the_mix(spark, tmp_path):
    rows = [(d, t, "en", "a", len(t)) for d, t in DOCS if t]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES:
        if name == "mix":
            break
        if name != "language":
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{name}")
    left = docs.collect()
    assert all(r.n_chars == len(r.text) for r in left)
    lines = [(r.doc_id, x) for r in left for x in {" ".join(x.split()) for x in r.text.split("\n")} if x]
    assert len({x for _, x in lines}) == len(lines)
    assert {"All rights reserved.", "rights reserved.", "Menu", "last"} <= {x for _, x in lines}
