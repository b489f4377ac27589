"""Bad CSV cells keep their text, and quarantine names them."""

import datetime

from pyspark.sql import functions as F

from stockflow import contract
from stockflow.operators.quality import SHIPMENT_RULES
from stockflow.sources import readers, rescue

GOOD = "s1,PRD-1,WH-EAST,2026-08-09,5,,OUTBOUND,SCHEDULED"
LINES = {
    GOOD: [],
    "s2,PRD-1,WH-EAST,2026-13-45,5,,OUTBOUND,SCHEDULED": ["scheduled_date"],
    "s3,PRD-1,WH-EAST,2026-8-4,4.0, 4,OUTBOUND,SCHEDULED": ["planned_pallet_quantity", "actual_pallet_quantity"],
    "s4,PRD-1,WH-EAST,2026-08-09,5,abc,OUTBOUND,SCHEDULED": ["actual_pallet_quantity"],
    "s5,PRD-1,WH-EAST": ["scheduled_date", "planned_pallet_quantity", "actual_pallet_quantity", "shipment_type", "shipment_status"],
    "s6,PRD-1,WH-EAST,2026-08-09,5,,OUTBOUND,SCHEDULED,x,y": [rescue.MORE_CELLS],
    "s7,PRD-1,WH-EAST,2026-08-09,5,,OUTBOUND,SCHEDULED,": [rescue.MORE_CELLS],
    's8,"a,b",WH-EAST,never,5,,OUTBOUND,"x ""y"""': ["scheduled_date"],
    ",,,,,,,": [],
}


def table(tmp_path, lines, header=True):
    path = tmp_path / "shipments.csv"
    names = [",".join(contract.column_names(contract.SHIPMENT_SCHEMA))] if header else []
    path.write_text("\n".join([*names, *lines]) + "\n")
    return str(path)


def test_text_and_columns_of_bad_rows(spark, tmp_path):
    path = table(tmp_path, LINES)
    found = rescue.read_rescued(spark, path, contract.SHIPMENT_SCHEMA)
    by_text = {r.source_text: r.failing_columns for r in found.collect() if r.source_text}
    assert by_text == {line: failing for line, failing in LINES.items() if failing}
    plain = readers.read_table(spark, path, contract.SHIPMENT_SCHEMA, "csv")
    assert sorted(map(repr, found.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_a_row_is_bad_whatever_is_selected(spark, tmp_path):
    found = rescue.read_rescued(spark, table(tmp_path, LINES), contract.SHIPMENT_SCHEMA)
    bad = sum(bool(f) for f in LINES.values())
    assert found.filter("source_text IS NOT NULL").count() == bad
    assert found.agg(F.count("source_text")).first()[0] == bad
    assert len(found.select("shipment_id", "source_text").filter("source_text IS NOT NULL").collect()) == bad
    assert found.select("failing_columns").filter("size(failing_columns) > 0").count() == bad


def test_quarantine_carries_the_text(spark, tmp_path):
    rows = rescue.read_rescued(spark, table(tmp_path, LINES), contract.SHIPMENT_SCHEMA)
    rescue.quarantine(rescue.once(rows, "shipment_id"), SHIPMENT_RULES, str(tmp_path / "out"))
    found = {r.shipment_id: r for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert set(found) == {"s2", "s3", "s4", "s5", "s6", "s7", "s8", None}
    assert {k for k, r in found.items() if r.verdict == "accepted"} == {"s4", "s6", "s7"}
    assert found["s4"].source_text.endswith("abc,OUTBOUND,SCHEDULED") and found["s4"].actual_pallet_quantity is None
    assert found[None].source_text is None and found[None].failing_columns is None


def test_of_equal_rows_the_one_read_in_full_stays(spark, tmp_path):
    bad = GOOD.replace("5,,", "5,n/a,")
    for lines in ([GOOD, bad], [bad, GOOD], [bad, bad]):
        rows = rescue.read_rescued(spark, table(tmp_path, lines, header=False), contract.SHIPMENT_SCHEMA, header=False)
        kept = rescue.once(rows, "shipment_id").collect()
        assert len(kept) == 1 and kept[0].scheduled_date == datetime.date(2026, 8, 9)
        assert kept[0].source_text == (bad if GOOD not in lines else None)
