"""Ids where only some columns are carried along."""

from clinspark.operators import domains
from clinspark.operators.ids import with_dense_ids


def rows(frame):
    """Ties, nulls and repeated rows."""
    values = [(i % 3 or None, i % 5, f"v{i % 4}" if i % 6 else None, float(i % 7)) for i in range(60)]
    return frame("a long, b long, c string, d double", *values)


def test_the_ids_do_not_depend_on_the_columns_kept(frame):
    df = rows(frame)
    whole = with_dense_ids(df, "id", ["a", "b"])
    part = with_dense_ids(df, "id", ["a", "b"], keep=["c"])
    assert part.columns == ["id", "c"]
    assert sorted(part.collect()) == sorted((r.id, r.c) for r in whole.collect())


def test_only_kept_columns_are_written(frame):
    part = with_dense_ids(rows(frame), "id", ["a", "b"], keep=["c"])
    files = part.sparkSession.read.parquet(*part.inputFiles())
    assert set(files.columns) == {"c", "_slot"}


def test_tables_in_some_columns_have_the_same_ids(frame):
    ex = frame(
        "USUBJID string, EXTRT string, EXSTDTC string, EXSEQ long",
        *[(f"s{i % 4}", f"t{i % 5}", "2020-01-01" if i % 3 else None, i % 6 or None) for i in range(40)],
    )
    columns = ["drug_source_value", "drug_exposure_id"]
    whole, part = domains.drug_exposure(ex, ex), domains.drug_exposure(ex, ex, columns=columns)
    assert part.columns == columns
    assert sorted(map(str, part.collect())) == sorted(map(str, whole.select(*columns).collect()))
    assert domains.drug_exposure(ex, None, ids=False, columns=columns).columns == columns
