import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinspark import contracts
from clinspark.functions import text
from clinspark.operators import acceptance, checks, domains
from clinspark.operators.ids import next_id, with_dense_ids
from clinspark.sources import domains as files
from clinspark.sources.vocabulary import read_vocabulary, write_vocabulary

SUBJECT = "STUDY-01-001"
D = dt.date


# --- ids ------------------------------------------------------------------------------------


def test_dense_ids_follow_the_order_despite_a_hot_key(spark):
    # A third of the rows share the leading key, and the key has nulls.
    rows = spark.range(0, 30000, 1, 7).select(
        F.expr("case when id % 3 = 0 then 5 when id % 100 = 1 then null else id % 50 end").alias("k"),
        F.expr("hash(id)").alias("v"),
    )
    got = with_dense_ids(rows, "n", ["k", "v"]).toPandas().sort_values("n")
    assert got["n"].tolist() == list(range(1, 30001))
    wanted = rows.toPandas().sort_values(["k", "v"], na_position="first")
    assert got["v"].tolist() == wanted["v"].tolist()


def test_dense_ids_of_equal_rows_and_of_nothing(spark, frame):
    twice = frame("a int, b string", (1, "x"), (1, "x"), (1, "a"))
    got = {(r.n, r.b) for r in with_dense_ids(twice, "n", ["a"], start=7).collect()}
    assert {n for n, _ in got} == {7, 8, 9}
    assert with_dense_ids(twice.where("a > 1"), "n", ["a"]).count() == 0
    assert next_id(None, "n") == 1 and next_id(frame("n long", (4,), (9,)), "n") == 10


# --- domains --------------------------------------------------------------------------------


def test_person(frame):
    dm = frame(
        "USUBJID string, SEX string, RACE string, ETHNIC string, BRTHDTC string",
        (SUBJECT, "F", "white", "Not Hispanic or Latino", "1980-02-03"),
        ("STUDY-01-002", "f", None, None, "unknown"),
        ("STUDY-01-003", "U", "UNKNOWN", "x", "1975"),
    )
    rows = {r.person_source_value: r for r in domains.person(dm).collect()}
    first = rows[SUBJECT]
    assert (first.gender_concept_id, first.race_concept_id, first.ethnicity_concept_id) == (8532, 8527, 38003564)
    assert (first.year_of_birth, first.month_of_birth, first.day_of_birth) == (1980, 2, 3)
    assert first.birth_datetime == dt.datetime(1980, 2, 3)
    second = rows["STUDY-01-002"]
    assert (second.gender_concept_id, second.race_concept_id, second.year_of_birth) == (0, 0, None)
    assert rows["STUDY-01-003"].year_of_birth == 1975


PERIOD = "USUBJID string, RFSTDTC string, RFENDTC string"


def test_observation_period_from_reference_dates(frame):
    row = domains.observation_period(frame(PERIOD, (SUBJECT, "2023-01-10", "2023-04-04"))).first()
    assert row.observation_period_start_date == D(2023, 1, 10)
    assert row.observation_period_end_date == D(2023, 4, 4)
    assert (row.period_type_concept_id, row.observation_period_id) == (32880, 1)


def test_observation_period_refuses_bad_references(frame):
    with pytest.raises(ValueError, match="invalid ends: 1"):
        domains.observation_period(frame(PERIOD, (SUBJECT, "2023-01-10", None)))
    with pytest.raises(ValueError, match="missing subject ids: 2.*reversed periods: 1; duplicate subjects: 2"):
        domains.observation_period(
            frame(
                PERIOD,
                (SUBJECT, "2023-01-10", "2023-01-09"),
                (SUBJECT, "2023-01-10", "2023-01-12"),
                (" ", "2023-01-10", "2023-01-12"),
                (None, "2023-01-10", "2023-01-12"),
            )
        )
    with pytest.raises(ValueError, match="lacks columns: RFENDTC"):
        domains.observation_period(frame("USUBJID string, RFSTDTC string", (SUBJECT, "2023-01-10")))


VISIT = "USUBJID string, VISITNUM double, VISIT string, SVSTDTC string, SVENDTC string"


def test_visits_keep_numbers_and_follow_the_order(frame):
    sv = frame(
        VISIT,
        (SUBJECT, 2.0, " Visit 2 ", "2023-02-09", "2023-02-09"),
        (SUBJECT, 1.0, "Visit 1", "2023-01-10", "2023-01-10"),
    )
    rows = domains.visit_occurrence(sv).orderBy("visit_occurrence_id").collect()
    assert [(r.visit_occurrence_id, r.source_visit_num, r.visit_source_value) for r in rows] == [
        (1, 1.0, "Visit 1"),
        (2, 2.0, "Visit 2"),
    ]
    assert {(r.visit_type_concept_id, r.visit_concept_id) for r in rows} == {(32809, 9202)}


def test_visits_refuse_repeats_and_gaps(frame):
    row = (SUBJECT, 1.0, "Visit 1", "2023-01-10", "2023-01-10")
    with pytest.raises(ValueError, match="duplicate subject visit numbers: 1"):
        domains.visit_occurrence(frame(VISIT, row, row))
    with pytest.raises(ValueError, match="invalid required values: 1; reversed visits: 1"):
        domains.visit_occurrence(
            frame(VISIT, (SUBJECT, 1.0, None, "2023-01-10", "2023-01-10"), (SUBJECT, 2.0, "V", "2023-01-10", "2023-01-09"))
        )


AE = "USUBJID string, AESTDTC string, AEENDTC string, AETERM string, AEDECOD string, AEOUT string"
MH = "USUBJID string, MHTERM string, MHSTDTC string"


def test_conditions_from_both_domains(frame):
    ae = frame(AE, (SUBJECT, "2023-01-10", "2023-01-11", "Application site erythema", "ERYTHEMA", "RECOVERED"))
    mh = frame(MH, (SUBJECT, "Hyperlipidemia", "21758"))
    rows = domains.condition_occurrence(ae, mh).orderBy("condition_occurrence_id").collect()
    assert [r.condition_source_value for r in rows] == ["ERYTHEMA", "Hyperlipidemia"]
    assert rows[0].condition_verbatim_source_value == "Application site erythema"
    assert rows[1].condition_start_date == D(2019, 7, 28) and rows[1].condition_end_date is None
    assert rows[1].condition_status_source_value == "Medical History"
    assert {r.condition_type_concept_id for r in rows} == {32809}
    assert [r.condition_occurrence_id for r in rows] == [1, 2]


def test_conditions_with_domains_absent(frame):
    mh = frame(MH, (SUBJECT, "Hyperlipidemia", "21758"))
    assert domains.condition_occurrence(None, mh).count() == 1
    assert domains.condition_occurrence(None, None) is None
    assert domains.drug_exposure(None, None) is None
    assert domains.measurement(None, None, None) is None


def test_history_refuses_unreadable_dates(frame):
    with pytest.raises(ValueError, match="unparseable dates: 1; missing terms: 1"):
        domains.condition_from_mh(frame(MH, (SUBJECT, "Hyperlipidemia", "not-a-date"), (SUBJECT, None, "21758")))


def test_drug_end_is_the_start_when_missing(frame):
    ex = frame(
        "USUBJID string, EXSTDTC string, EXENDTC string, EXTRT string, EXDOSE double",
        (SUBJECT, "2023-01-10", None, "Placebo", 1.0),
    )
    row = domains.drug_exposure(ex, None).first()
    assert row.drug_exposure_start_date == row.drug_exposure_end_date == D(2023, 1, 10)
    assert (row.drug_type_concept_id, row.quantity, row.dose_unit_source_value) == (32809, 1.0, None)
    # The day-count rule does not apply to drug dates.
    ex = frame("USUBJID string, EXSTDTC string, EXTRT string", (SUBJECT, "23020", "Placebo"))
    assert domains.drug_exposure(ex, None).first().drug_exposure_start_date is None


EG = "USUBJID string, EGDTC string, EGTEST string, EGORRES string, EGORRESU string"


def test_ecg_measurement(frame):
    row = domains.measurement(None, None, frame(EG, (SUBJECT, "23020", "Heart Rate", "69", "beats/min"))).first()
    assert row.measurement_date == D(2023, 1, 10)
    assert (row.value_as_number, row.measurement_source_domain, row.unit_concept_id) == (69.0, "EG", 8541)
    assert (row.unit_source_value, row.unit_source_concept_id, row.measurement_source_concept_id) == ("beats/min", 0, 0)


def test_ecg_refuses_bad_rows(frame):
    with pytest.raises(ValueError, match="unparseable dates: 1; non numeric results: 1"):
        domains.measurement_from_eg(frame(EG, (SUBJECT, "not-a-date", "Heart Rate", "high", "beats/min")))


def test_contract_report_is_long(frame):
    report = checks.contract_report([checks.check_history(frame(MH, (SUBJECT, None, "x")))])
    assert {(r.rule, r.violations) for r in report.collect()} == {("unparseable_dates", 1), ("missing_terms", 1)}


# --- contracts and files --------------------------------------------------------------------


def test_contract_sizes():
    assert len(contracts.columns_of("person")) == 18
    assert len(contracts.columns_of("measurement")) == 23
    assert len(contracts.columns_of("concept")) == 10
    assert len(contracts.columns_of("concept_relationship")) == 6
    assert len(contracts.columns_of("cdm_source")) == 11
    with pytest.raises(ValueError, match="Unsupported datatype"):
        contracts.spark_type("blob")


def test_contracts_from_a_specification_file(spark, tmp_path):
    spec = tmp_path / "fields.csv"
    spec.write_text(
        "cdmTableName,cdmFieldName,isRequired,cdmDatatype,isPrimaryKey,isForeignKey,fkTableName,fkFieldName,fkDomain\n"
        "NOTE,note_id,Yes,integer,TRUE,FALSE,NA,NA,NA\n"
        'NOTE,"""offset""",FALSE,varchar(50),FALSE,FALSE,,,\n'
        "NOTE,note_type_concept_id,TRUE,integer,FALSE,TRUE,CONCEPT,CONCEPT_ID,Type Concept\n"
    )
    note = contracts.read_contracts(spark, str(spec))["note"]
    assert [f.name for f in note] == ["note_id", "offset", "note_type_concept_id"]
    assert note[0].primary_key and not note[0].required and note[2].required and note[2].is_concept


def test_conform_reads_text_and_fills_optional_concepts(frame):
    raw = frame(
        "person_id string, gender_concept_id string, year_of_birth string, race_concept_id string, "
        "ethnicity_concept_id string, gender_source_concept_id string, extra string",
        ("1", "8840.0", " 1980 ", "2.5", "0", " ", "x"),
    )
    got = acceptance.conform(raw, "person")
    assert got.schema.names == contracts.columns_of("person")
    assert not contracts.schema_problems(got, "person")
    row = got.first()
    assert (row.gender_concept_id, row.year_of_birth, row.race_concept_id) == (8840, 1980, 3)
    assert (row.gender_source_concept_id, row.race_source_concept_id, row.location_id) == (0, 0, None)
    bad = raw.withColumn("year_of_birth", F.lit("old"))
    problems = acceptance.unreadable_values(bad, "person").collect()
    assert [(r.column_name, r.violations) for r in problems] == [("year_of_birth", 1)]


def test_conform_requires_columns(frame):
    with pytest.raises(ValueError, match="lacks required columns: gender_concept_id"):
        acceptance.conform(frame("person_id long", (1,)), "person")
    measurement = frame(
        "measurement_id long, person_id long, measurement_concept_id long, measurement_date date, "
        "measurement_type_concept_id long",
        (1, 1, 0, D(2023, 1, 1), 0),
    )
    with pytest.raises(ValueError, match="keep source values: measurement_source_concept_id, unit_concept_id"):
        acceptance.conform(measurement, "measurement")


def test_domain_files(spark, frame, tmp_path):
    ae = frame("AETERM string, USUBJID string, AESEQ double", (' "odd", term ', SUBJECT, 3.0), (None, SUBJECT, None))
    path = str(tmp_path / "ae")
    files.write_table(ae, path, "csv")
    got = files.read_domain(spark, "AE", path, "csv")
    assert {(r.USUBJID, r.AETERM, r.AESEQ) for r in got.collect()} == {
        (SUBJECT, ' "odd", term ', 3.0),
        (SUBJECT, None, None),
    }
    assert files.read_domain_if_present(spark, "MH", str(tmp_path / "mh")) is None
    staged = files.read_staging_csv(spark, path)
    assert dict(staged.dtypes) == {"AETERM": "string", "USUBJID": "string", "AESEQ": "string"}


def test_manifest(spark, tmp_path):
    (tmp_path / "dm.bin").write_bytes(b"abc")
    rows = files.input_manifest(spark, [str(tmp_path / "dm.bin"), str(tmp_path / "sv.bin")]).collect()
    here = next(r for r in rows if not r.missing)
    assert here.size_bytes == 3 and here.sha256.startswith("ba7816bf")
    assert [r.path.endswith("sv.bin") for r in rows if r.missing] == [True]
    light = files.input_manifest(spark, [str(tmp_path / "dm.bin")], with_hash=False).first()
    assert light.sha256 is None and light.size_bytes == 3


def test_manifest_of_files_in_many_ranges(spark, tmp_path):
    import hashlib

    content = {"a b.bin": bytes(range(256)) * 40, "even.bin": b"x" * 4096, "small.bin": b"y" * 1000, "none.bin": b""}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    found = files.input_manifest(spark, [f"{tmp_path}/*.bin"], range_bytes=1024).collect()
    got = {r.path.rpartition("/")[2]: (r.size_bytes, r.ranges, r.sha256) for r in found}
    for name, data in content.items():
        parts = [hashlib.sha256(data[i : i + 1024]).hexdigest() for i in range(0, len(data), 1024)]
        whole = hashlib.sha256(data).hexdigest() if len(parts) < 2 else hashlib.sha256("".join(parts).encode()).hexdigest()
        assert got[name] == (len(data), max(len(parts), 1), whole)


def test_manifest_of_a_file_larger_than_a_row(spark, tmp_path):
    """Three gigabytes, none of them on the disk."""
    path = tmp_path / "large.bin"
    with path.open("wb") as file:
        file.truncate(3 << 30)
    row = files.input_manifest(spark, [str(path)]).first()
    assert (row.size_bytes, row.ranges) == (3 << 30, 48) and len(row.sha256) == 64


def test_vocabulary_files(spark, frame, tmp_path):
    path = tmp_path / "CONCEPT.csv"
    names = contracts.columns_of("concept")
    lines = [
        ["1", 'A "quoted name', "Condition", "V", "C", "S", "A", "20200101", "20991231", ""],
        ["2", "Other", "Condition", "V", "C", "", "B", "2020-01-01", "20991231", "D"],
    ]
    body = ["\t".join([*names, "more"])] + ["\t".join([*row, "x"]) for row in lines]
    path.write_text("\n".join(body) + "\n")
    concept = read_vocabulary(spark, "concept", str(path))
    assert not contracts.schema_problems(concept, "concept")
    rows = concept.orderBy("concept_id").collect()
    assert rows[0].concept_name == 'A "quoted name' and rows[0].invalid_reason is None
    assert rows[1].valid_start_date == D(2020, 1, 1) and rows[1].standard_concept is None
    write_vocabulary(concept, str(tmp_path / "again"))
    assert read_vocabulary(spark, "concept", str(tmp_path / "again")).orderBy("concept_id").collect() == rows
    path.write_text("concept_id\tconcept_name\n1\tx\n")
    with pytest.raises(ValueError, match="missing fields"):
        read_vocabulary(spark, "concept", str(path))


def test_person_ids_agree_between_tables(frame):
    ae = frame(AE, (SUBJECT, "2023-01-10", None, "x", None, None))
    dm = frame(PERIOD, (SUBJECT, "2023-01-10", "2023-04-04"))
    person = dm.select(text.person_id(F.col("USUBJID"))).first()[0]
    assert domains.condition_occurrence(ae, None).first().person_id == person
