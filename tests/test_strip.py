"""Blanks are stripped as before, and most text is not searched for them."""

from pyspark.sql import functions as F

from clinspark.functions import text
from clinspark.operators import domains

_ODD = ["\t", "\n", "\x1c", " ", "\x85", "\xa0", " ", " ", " ", "　", "\x00", "\x7f", "​", "é", "ß"]


def test_strip_equals_the_search_for_every_blank(spark):
    """``btrim`` over the whole list is what strip did to every text before."""
    samples = ["", "a", "~", "!", "a b", "a\nb", "Customer#000000001", None]
    samples += [a + "x y" + b for a in ["", *_ODD] for b in ["", *_ODD]]
    samples += _ODD + [c + c for c in _ODD] + ["x\r\n", "\nx", "x" * 300 + " "]
    rows = spark.createDataFrame([(s,) for s in samples], "s string")
    found = rows.select(
        "s", text.strip(F.col("s")).alias("got"), F.btrim("s", F.lit(text.BLANKS)).alias("wanted")
    ).collect()
    assert len(found) == len(samples)
    assert [(r.s, r.got) for r in found] == [(r.s, r.wanted) for r in found]


def _method_size(spark, df) -> int:
    shown = df._jdf.queryExecution().executedPlan()
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(shown)
    return max(int(part.partition(";")[0]) for part in code.split("maxMethodCodeSize:")[1:])


def test_measurement_code_is_small_enough_to_be_compiled(spark, tmp_path):
    """The JVM interprets methods of more than 8000 bytes."""
    schema = "USUBJID string, LBDTC string, LBTEST string, LBORRES string, LBORRESU string, VISIT string, "
    schema += "LBSEQ long, LBSTRESN double, VISITNUM double"
    path = str(tmp_path / "lb")
    spark.createDataFrame([("S1", "2023-01-02", "t", "1", "mg/dL", "v", 1, 1.0, 1.0)], schema).write.parquet(path)
    rows = domains.measurement_from_lb(spark.read.parquet(path))
    assert _method_size(spark, rows) < 8000
    assert rows.select("person_id", "measurement_date").first().person_id is not None


def test_visible_text_is_not_searched_for_blanks(spark):
    """The list of blanks is searched only where one match finds a text that may have some."""
    plan = spark.range(1).select(text.strip(F.col("id").cast("string")).alias("s"))
    assert "CASE WHEN RLIKE" in plan._jdf.queryExecution().optimizedPlan().toString()
