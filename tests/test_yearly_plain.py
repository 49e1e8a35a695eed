"""The yearly averages of plain doubles are registered, with SQL of their own."""
import __spark_entry__ as entry


def test_yearly_plain_is_registered():
    assert "fact_yearly_plain" in entry.queries()
    sql = entry.oracle_sql()["fact_yearly_plain"]
    assert sql != entry.oracle_sql()["fact_yearly"] and "AVG(avg_ma_5)" in sql
