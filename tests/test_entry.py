import re

import __spark_entry__ as E


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert len(q) > 100
    assert set(s) <= set(q)
    own = {n for n in q if not re.match(r"op\d+_|pipeline$", n)}
    assert own - set(s) <= {"train_linear", "score_table"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["numeroControlePNCP", "objetoCompra", "dataAtualizacao", "dataEncerramentoProposta",
                          "dataPublicacaoPncp", "uf", "feed", "ingest_seq"]
