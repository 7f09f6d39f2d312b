"""A query against its SQL over one folder of tables."""

import duckdb


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)
    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, sf_dir, query, sql):
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    cursor = connection.execute(sql)
    wanted = _rows([c[0] for c in cursor.description], cursor.fetchall())
    frame = query(spark, sf_dir)
    assert _rows(frame.columns, [tuple(r) for r in frame.collect()]) == wanted
