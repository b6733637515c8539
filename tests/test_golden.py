"""An invented set of delimited files from raw to gold: byte order mark, accents, thresholds, stray keys."""

import datetime as dt

import pytest

from caskline.operators.cleanse import CLEANERS
from caskline.plans.dashboard import kpi_card, monthly_trend
from caskline.plans.warehouse import build_gold
from caskline.operators import dimensions as dims
from caskline.operators.facts import sales_measures, with_price
from caskline.sources.ingest import ingest
from caskline.sources.publish import read_published
from caskline.sources.schemas import ENTITIES

FILES = {
    "sales_reps": [" 1 ,Zoë Ångström , North,on-premise,2019-02-01,Z@X.COM", "01,Zoë Old,North,OFF-PREMISE,x,", "2,B,South,,2020-01-01,b@x"],
    "suppliers": ["1,Château É, wines and spirits,France", "2,Dry,SPIRITS,USA"],
    "products": ["10,Red,1,Wine,Bottle,750,24.00", "11,Gin,2,Spirits,Bottle,n/a,tbd"],
    "accounts": ["5,Café Ñ,Bar,ON-PREMISE,Town,ct,North,1,", "6,Shop,Store,Off-Premise,Town,ct,South,9,1"],
    "supplier_programs": ["3,1,2024-Q1,2024-01-01,2024-03-31,Volume,100,500.00,North", "4,2,2024-Q1,2024-03-31,2024-01-01,Volume,1,1,North"],
    "sales_transactions": [
        "100,2019-12-31,5,1,North,10,1,4,5.00,96.00,on-premise", "101,2024-01-31,5,1,North,10,1,2,,48.00,ON-PREMISE",
        "102,2024-02-01,6,2,South,11,2,1,0,30.00,Off-Premise", "103,2031-05-05,6,2,South,11,2,1,0,20.00,Off-Premise",
        "104,bad,6,2,South,11,2,1,0,20.00,Off-Premise", "105,2024-02-02,6,2,South,11,2,0,0,20.00,Off-Premise",
    ],
    "rep_quota_actuals": ["1,Z,North,2024-01,10,10,100.00,100.00,100.00", "1,Z,North,2024-02,10,8,75.00,100.00,80.00", "1,Z,North,2024-03,10,7,74.99,100.00,70.00"],
    "program_attainments": ["7,3,1,2024-Q1,1,Z,North,Volume,100,50,50.00,behind,0"],
}


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    tables = {}
    for name, rows in FILES.items():
        path = folder / f"{name}.csv"
        header = ",".join(ENTITIES[name].raw_columns)
        path.write_bytes(b"\xef\xbb\xbf" * (name == "accounts") + "\r\n".join([header, *rows, ""]).encode())
        tables[name] = CLEANERS[name](ingest(spark, str(path), ENTITIES[name])).cache()
    return tables


def test_rows_and_labels(silver):
    assert {n: df.count() for n, df in silver.items()} == {
        "sales_reps": 2, "suppliers": 2, "products": 2, "accounts": 2, "supplier_programs": 1, "sales_transactions": 6,
        "rep_quota_actuals": 3, "program_attainments": 1,
    }
    assert {r.account_name for r in silver["accounts"].collect()} == {"Café Ñ", "Shop"}
    assert {r.account_id: r.is_active for r in silver["accounts"].collect()} == {5: False, 6: True}
    flags = {r.month_year: r.performance_flag for r in silver["rep_quota_actuals"].collect()}
    assert flags == {"2024-01": "Achieved", "2024-02": "At Risk", "2024-03": "Behind"}
    assert {r.txn_id: r.is_valid for r in silver["sales_transactions"].collect()} == {
        100: True, 101: True, 102: True, 103: True, 104: False, 105: False,
    }


def test_gold_counts_every_valid_sale(spark, silver, tmp_path):
    audit = build_gold(spark, silver, str(tmp_path), as_of=dt.date(2024, 12, 31)).collect()
    assert all(r.ok for r in audit)
    fact = read_published(spark, f"{tmp_path}/fact_sales")
    assert fact.count() == 4 and fact.where("dwh_create_date is null").count() == 0
    days = read_published(spark, f"{tmp_path}/dim_date").selectExpr("min(full_date) a", "max(full_date) b").first()
    assert (days.a, days.b) == (dt.date(2019, 1, 1), dt.date(2031, 12, 31))
    sales = sales_measures(with_price(silver["sales_transactions"], silver["products"]))
    reps = dims.dim_reps(silver["sales_reps"], as_of=dt.date(2024, 12, 31), keyed=False)
    accounts = dims.dim_accounts(silver["accounts"], keyed=False)
    months = monthly_trend(sales).collect()
    assert sum(r.net_revenue for r in months) == kpi_card(sales, accounts, reps).first().total_net_revenue == 194
