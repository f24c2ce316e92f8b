from datetime import date

from ticketlens.operators import measures
from ticketlens.plans import analysis, pages, reports

SLICERS = {
    "channel": ["HIGH", "LOW"],
    "category": ["LARGE", "SMALL", "PROMO"],
    "customer_region": ["Asia", "Europe"],
    "month": [date(1997, m, 1) for m in range(1, 13)],
}


def test_slicers_reach_every_visual(star):
    page = pages.overview(star, SLICERS)
    wide = measures.sliced(star.detail("customer_region"), SLICERS)
    assert page["cards"].first() == measures.evaluate(wide).first()
    n = wide.count()
    assert n > 0
    for name in ("monthly_trend", "csat_by_bucket", "tickets_by_channel", "tickets_by_category"):
        assert sum(r["tickets"] for r in page[name].collect()) == n
    second = pages.channel_and_category(star, SLICERS)
    assert {r["customer_region"] for r in second["regional_csat"].collect()} == {"Asia", "Europe"}
    assert sum(r["tickets"] for r in second["sla_breach"].collect()) == n
    assert {r["channel"] for r in second["top_categories"].collect()} == {"HIGH", "LOW"}
    assert second["channel_bucket_matrix"].count() == 2


def test_pages_without_slicers_show_everything(star):
    page = pages.overview(star)
    assert page["monthly_trend"].collect() == analysis.monthly_volume(star.tickets).collect()
    agents = pages.agent_performance(star)
    assert agents["leaderboard"].count() == star.agents.count()
    assert sum(r["agents"] for r in agents["quartiles"].collect()) == star.agents.count()


def test_workbook_can_be_exported(spark, star, tmp_path):
    sheets = pages.workbook(star)
    reports.export(sheets, str(tmp_path), "csv")
    for name, df in sheets.items():
        # quoted fields of the raw sheet have line breaks
        back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / name))
        assert back.columns == df.columns and back.count() == df.count() > 0
    assert pages.workbook(star, "AG3")["agent_lookup"].first()["agent_id"] == "AG3"
