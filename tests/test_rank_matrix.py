"""The rank correlation matrix over every column of the embeddings, against brute force."""

import duckdb
import numpy as np
import pandas as pd

from tarnwork.catalog import registered

SF = "/root/testdata/sf0.001"


def test_every_column_is_ranked(spark):
    q = registered()["ml03_spearman_matrix_all_columns"]
    vectors = np.array(spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()["embedding"].tolist(), float)
    want = pd.DataFrame(vectors).rank().corr().to_numpy()
    got = {(r.i, r.j): r.v for r in q(spark, SF).collect()}
    n = vectors.shape[1]
    assert n > 16 and set(got) == {(i, j) for i in range(n) for j in range(n)}
    assert all(abs(got[i, j] - want[i, j]) < 1e-6 for i, j in got)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert {(i, j): v for i, j, v in con.execute(q.oracle).fetchall()} == got
