"""The command line over small stored stars."""

from shelfwise.__main__ import main
from shelfwise.sources.sinks import sink_star
from tests.test_sources import DAY, small
from tests.tiny import sale


def test_load_then_query(spark, tmp_path, capsys):
    twin = sale(3, DAY)
    raw = small(spark, fact_sales=[{**sale(1, DAY), "unit_price": None}, twin, {**twin, "sales_key": 4}])
    folder = str(tmp_path / "raw")
    sink_star(raw, folder, fmt="csv")
    warehouse = str(tmp_path / "dw")
    assert main(["--csv", "load", folder, str(tmp_path / "staging"), warehouse], spark) == 0
    assert main(["check", warehouse], spark) == 0
    assert main(["kpi", warehouse], spark) == 0
    assert main(["run", warehouse, "q18"], spark) == 0
    assert main(["run", warehouse, "m_total_revenue", "--by", "category", "--where", "year=2024"], spark) == 0
    out = capsys.readouterr().out
    assert "gate passed" in out and "Total Revenue" in out and "total_revenue" in out


def test_report_and_failing_check(spark, tmp_path, capsys):
    folder = str(tmp_path / "bad")
    sink_star(small(spark, fact_sales=[sale(1, DAY, p=404), sale(2, DAY)]), folder)
    assert main(["check", folder], spark) == 1
    capsys.readouterr()
    assert main(["report", folder], spark) == 0
    rows = [[cell.strip() for cell in line.strip("|").split("|")] for line in capsys.readouterr().out.splitlines() if line.startswith("|")]
    log = next(r for r in rows if r[0] == "fact_sales")
    assert log[1:3] == ["2", "0"]  # rows in, duplicates removed
    failed = [r for r in rows if r[-1] == "FAIL"]
    assert failed and any(r[2] == "1" and "404" in r[5] for r in failed)
    assert rows[-1][-1] == "false"  # the gate stays shut
