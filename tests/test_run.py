import pytest
from helpers import rows, same
from pyspark.sql import functions as F

from namewright.operators.metrics import component_status, errors
from namewright.plans.run import EntityTables, last_run, run_log, run_mode
from namewright.sources.tables import load_table, table_exists, write_table

PEOPLE = [
    ("u3", "Old A", "A", "P"),
    ("u1", "A", "A", "P"),
    ("u2", "Old A", "A", "P"),
    ("u4", "B", "B", "P"),
    ("u5", " ", "B", "P"),
]


def stamp():
    return F.lit("2024-01-01").cast("timestamp_ntz")


@pytest.fixture
def base(spark, folder):
    names = "uuid_institution string, institution string, english_name string, parent_institution string"
    write_table(spark.createDataFrame(PEOPLE, names), folder, "institution")
    countries = [("u1", "NL"), ("u2", "NL"), ("u3", "US")]
    write_table(spark.createDataFrame(countries, "uuid_institution string, uuid_country string"), folder, "institution_country")
    edges = [("u3", "Old A"), ("u4", "B")]
    write_table(spark.createDataFrame(edges, "uuid_institution string, organisation string"), folder, "member")
    with open(f"{folder}/mapping.csv", "w", encoding="utf-8") as out:
        out.write("original,normalized\nOld A,A\nbad\n")
    return folder


def _sync(spark, base, **options):
    return run_mode(spark, base, "sync-now", mapping_csv=f"{base}/mapping.csv", as_of=stamp(), **options)


def test_whole_run(spark, base):
    report = _sync(spark, base, names=EntityTables(edges=(("member", "organisation"),)))
    assert report.success and [s.rows for s in report.steps] == [1, 4, 4, 4]
    details = {s.name: s.details for s in report.steps}
    assert details["load-mapping"]["rejected"] == 1
    assert details["update-uuids"]["updated"] == 1
    assert details["add-columns"]["skipped"] == []
    out = load_table(spark, base, "deduplicated_institutions")
    assert rows(out.select("id", "institution", "uuid_institution", "uuid_deprecated", "uuid_country")) == [
        (1, "A", "u1", None, "NL"),
        (2, "A", "u1", "u2", "NL"),
        (3, "A", "u3", None, "US"),
        (4, "B", "u4", None, None),
    ]
    edge = load_table(spark, base, "deduplicated_member")
    assert rows(edge.select("organisation", "original_organisation", "was_deduplicated")) == [
        ("A", "Old A", True),
        ("B", "B", False),
    ]


def test_running_again_changes_nothing(spark, base):
    _sync(spark, base)
    once = load_table(spark, base, "deduplicated_institutions")
    assert _sync(spark, base).success
    assert same(once, load_table(spark, base, "deduplicated_institutions"))


def test_modes(spark, base):
    assert run_mode(spark, base, "load-mapping", mapping_csv=f"{base}/mapping.csv").success
    report = run_mode(spark, base, "run-all", as_of=stamp())
    assert report.success and len(report.steps) == 3
    again = run_mode(spark, base, "add-columns")
    assert again.success and "id" in again.steps[0].details["skipped"]
    checked = run_mode(spark, base, "check-duplicates")
    assert checked.success and checked.steps[0].rows > 0
    found = load_table(spark, base, "deduplicated_institutions_duplicates")
    assert rows(found.filter("column = 'institution'")) == [("institution", "a", 3, 0, [1, 2, 3])]
    with pytest.raises(ValueError, match="unknown mode"):
        run_mode(spark, base, "nonsense")


def test_dry_run_touches_nothing(spark, base):
    report = _sync(spark, base, dry_run=True)
    assert [s.success for s in report.steps] == [None] * 4
    assert not table_exists(spark, base, "institution_mapping") and run_log(spark, base).isEmpty()


def test_a_failure_is_reported_and_stops_the_run(spark, base):
    report = run_mode(spark, base, "run-all")
    assert not report.success
    assert [s.success for s in report.steps] == [False, None, None]
    assert "institution_mapping does not exist" in report.steps[0].error
    going_on = run_mode(spark, base, "run-all", continue_on_error=True)
    assert [s.success for s in going_on.steps] == [False, False, False]
    assert not table_exists(spark, base, "deduplicated_institutions")


def test_preconditions(spark, base):
    run_mode(spark, base, "load-mapping", mapping_csv=f"{base}/mapping.csv")
    run_mode(spark, base, "apply-deduplication")
    report = run_mode(spark, base, "update-uuids")
    assert "lacks column(s): id" in report.steps[0].error


def test_without_countries(spark, folder):
    names = "uuid_institution string, institution string, english_name string, parent_institution string"
    write_table(spark.createDataFrame(PEOPLE, names), folder, "institution")
    write_table(spark.createDataFrame([("Old A", "A")], "original string, normalized string"), folder, "institution_mapping")
    report = run_mode(spark, folder, "run-all")
    assert report.success and report.steps[1].details["skipped"] == ["institution_country does not exist"]
    assert report.steps[2].details["updated"] == 2


def test_run_log_feeds_the_metrics(spark, base):
    run_mode(spark, base, "run-all")
    _sync(spark, base)
    log = run_log(spark, base)
    assert log.count() == 5
    assert [r["component"] for r in errors(log).collect()] == ["apply-deduplication"]
    status = {r["component"]: r["status"] for r in component_status(log).collect()}
    assert status["apply-deduplication"] == "DEGRADED" and status["update-uuids"] == "OK"
    assert {r["component"] for r in last_run(spark, base).collect()} == {
        "load-mapping", "apply-deduplication", "add-columns", "update-uuids",
    }
