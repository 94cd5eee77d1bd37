from oracle import rows_of, rows_of_sql

from folioscope.llm import queries


def compare(name, spark, sf_dir, duck):
    names, rows = rows_of(queries.QUERIES[name](spark, sf_dir))
    sql_names, sql_rows = rows_of_sql(duck, queries.SQL[name])
    assert names == sql_names
    assert rows == sql_rows
