"""Golden rows of the clean layer."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parceltrail.functions.delivery import region_of
from parceltrail.functions.text import capitalise_words, category_label
from parceltrail.plans import gold, silver

ORDER_COLUMNS = (
    "order_id customer_id order_status order_purchase_timestamp order_approved_at "
    "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"
)


def order(oid, customer, status, purchase, delivered, estimated):
    return (oid, customer, status, purchase, None, None, delivered, estimated)


ORDERS = [
    order("o1", "c1", "DELIVERED", "2018-01-01 10:00:00", "2018-01-03 09:00:00", "2018-01-03 00:00:00"),
    order("o2", "c2", "Delivered", "2018-01-02 08:00:00", "2018-01-09 09:00:00", "2018-01-10 00:00:00"),
    order("o3", "c3", "delivered", "2018-01-02 09:00:00", "2018-01-08 12:00:00", "2018-01-10 00:00:00"),
    order("o4", "c4", "delivered", "2018-01-02 11:00:00", None, "2018-01-10 00:00:00"),
    order("o5", "c5", "shipped", "2018-01-03 11:00:00", "2018-02-10 00:00:00", "2018-01-10 00:00:00"),
    order("o6", "c6", "delivered", "2018-01-03 12:00:00", "2018-03-15 00:00:00", "2018-01-02 00:00:00"),
    order("o7", "old", "delivered", "2018-01-04 08:00:00", "2018-01-05 00:00:00", "2018-01-10 00:00:00"),
    order("o7", "new", "canceled", "2018-01-04 09:00:00", None, "2018-01-10 00:00:00"),
    order("o8", "dated", "delivered", "2018-01-04 09:30:00", "2018-01-05 00:00:00", "2018-01-10 00:00:00"),
    order("o8", "nullts", "shipped", None, None, None),
    order("o9", "c9", None, "2018-01-04 09:00:00", "2018-01-20 00:00:00", "2018-01-10 00:00:00"),
]

EXPECTED = [
    ("o1", "c1", "delivered", 0, True),
    ("o2", "c2", "delivered", 0, False),
    ("o3", "c3", "delivered", -1, False),
    ("o4", "c4", "delivered", None, False),
    ("o5", "c5", "shipped", None, False),
    ("o6", "c6", "delivered", 72, True),
    ("o7", "new", "canceled", None, False),
    ("o8", "nullts", "shipped", None, False),
    ("o9", "c9", None, None, False),
]

ITEM_COLUMNS = "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"


@pytest.fixture
def bronze_orders(text_table):
    return text_table(ORDER_COLUMNS, ORDERS)


def items(text_table, *rows):
    return text_table(ITEM_COLUMNS, list(rows))


def test_orders(bronze_orders):
    rows = (
        silver.orders(bronze_orders)
        .select("order_id", "customer_id", "order_status", "delay_days", "is_late")
        .orderBy("order_id")
    )
    assert [tuple(r) for r in rows.collect()] == EXPECTED


def test_orders_schema(bronze_orders):
    types = dict(silver.orders(bronze_orders).dtypes)
    assert types["delay_days"] == "int" and types["is_late"] == "boolean"
    assert types["purchase_timestamp"] == "timestamp_ntz" and types["updated_at"] == "timestamp"
    assert "order_purchase_timestamp" not in types and "purchase_text" not in types


def test_run_clock_can_be_set(bronze_orders):
    now = datetime(2020, 5, 17, 12, 0, 0)
    rows = silver.orders(bronze_orders, now).select(F.col("updated_at").cast("string")).distinct()
    assert [r[0] for r in rows.collect()] == ["2020-05-17 12:00:00"]


def test_fact_keeps_delivered_orders_only(bronze_orders, text_table):
    ids = sorted({r[0] for r in ORDERS})
    bronze_items = items(
        text_table, *[(i, "1", "p", "s", "2018-01-01 00:00:00", "1.00", "0.50") for i in ids]
    )
    fact = gold.orders_fact(silver.orders_items(bronze_items), silver.orders(bronze_orders))
    rows = {r.order_id: (r.total_amount, r.delay_days, r.is_late) for r in fact.collect()}
    assert rows == {
        "o1": (Decimal("1.50"), 0, True),
        "o2": (Decimal("1.50"), 0, False),
        "o3": (Decimal("1.50"), -1, False),
        "o4": (Decimal("1.50"), None, False),
        "o6": (Decimal("1.50"), 72, True),
    }
    assert dict(fact.dtypes)["total_amount"] == "decimal(11,2)"


def test_latest_compares_raw_text(text_table):
    # As text "2018-01-09 9:..." is greater than "2018-01-09 10:...", as time it is not.
    bronze_items = items(
        text_table,
        ("o", "1", "by_time", "s", "2018-01-09 10:00:00", "1", "1"),
        ("o", "1", "by_text", "s", "2018-01-09 9:00:00", "1", "1"),
    )
    assert silver.orders_items(bronze_items).first().product_id == "by_text"


def test_ties_are_broken_the_same_way_in_any_input_order(text_table):
    rows = [("o", "1", f"p{i}", "s", "2018-01-01 00:00:00", str(i), "1") for i in range(9)]
    picks = {silver.orders_items(items(text_table, *part)).first().product_id
             for part in (rows, rows[::-1], rows[4:] + rows[:4])}
    assert len(picks) == 1


def test_item_amounts_round_half_up(text_table):
    row = silver.orders_items(
        items(text_table, ("o", "1", "p", "s", "2018-01-01 00:00:00", "1.005", "2.00"))
    ).first()
    assert (row.price, row.total_item_value) == (Decimal("1.01"), Decimal("3.01"))


def test_null_operand_gives_null_total(text_table):
    row = silver.orders_items(items(text_table, ("o", "1", "p", "s", None, "1.00", None))).first()
    assert row.total_item_value is None


@pytest.mark.parametrize(
    "row",
    [
        ("o", "1", "p", "s", "2018-01-01 00:00:00", "123456789.00", "1"),
        ("o", "1", "p", "s", "02/10/2017", "1", "1"),
        ("o", "1", "p", "s", "2018-01-01 00:00:00", "abc", "1"),
    ],
)
def test_bad_cast_fails(text_table, row):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE"):
        silver.orders_items(items(text_table, row)).collect()


def test_bad_cast_fails_in_a_row_that_would_be_dropped(text_table):
    good = ("o", "1", "p", "s", "2018-01-02 00:00:00", "1", "1")
    old = ("o", "1", "p", "s", "2018-01-01 00:00:00", "abc", "1")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.orders_items(items(text_table, good, old)).collect()


def test_sellers(text_table):
    bronze = text_table(
        "seller_id seller_zip_code_prefix seller_city seller_state",
        [("s1", "01001", "mogi-guacu", "sp"), ("s2", " 40 ", "santa barbara d'oeste", "Rj")],
    )
    rows = silver.sellers(bronze).drop("updated_at").orderBy("seller_id").collect()
    assert [tuple(r) for r in rows] == [
        ("s1", 1001, "Mogi-Guacu", "SP"),
        ("s2", 40, "Santa Barbara D'Oeste", "RJ"),
    ]


def test_zip_with_decimal_point_fails(text_table):
    bronze = text_table(
        "seller_id seller_zip_code_prefix seller_city seller_state", [("s", "40.0", "x", "sp")]
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.sellers(bronze).collect()


def test_products(text_table):
    bronze = text_table(
        "product_id product_category_name product_name_lenght product_description_lenght "
        "product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm",
        [
            ("p1", "moveis_decoracao", "40", "300", "1", "225", "20", "10.5", "3"),
            ("p2", None, None, None, None, None, None, "1", "1"),
            (None, "a", None, None, None, None, None, None, None),
            (None, "b", None, None, None, None, None, None, None),
        ],
    )
    products = silver.products(bronze)
    assert products.count() == 3  # rows without a key are one group
    dims = {r.product_id: r for r in gold.dim_products(products).collect()}
    assert dims["p1"].product_category == "Moveis Decoracao"
    assert dims["p1"].product_volume_cm3 == Decimal("630.000000")
    assert dims["p2"].product_category == "Sem Categoria"
    assert dims["p2"].product_volume_cm3 is None
    assert dict(gold.dim_products(products).dtypes)["product_volume_cm3"] == "decimal(32,6)"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("mogi-guacu", "Mogi-Guacu"),
        ("santa barbara d'oeste", "Santa Barbara D'Oeste"),
        ("SAO PAULO", "Sao Paulo"),
        ("são josé", "São José"),
        ("lages - sc", "Lages - Sc"),
        ("2nd street", "2nd Street"),
        ("ßa élan", "ßa Élan"),
        ("  two  blanks ", "  Two  Blanks "),
        ("", ""),
        (None, None),
    ],
)
def test_capitalise_words(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(capitalise_words(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("moveis_decoracao", "Moveis Decoracao"),
        ("eletrodomesticos_2", "Eletrodomesticos 2"),
        (None, "Sem Categoria"),
    ],
)
def test_category_label(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(category_label(F.col("t"))).first()[0] == expected


def test_regions(spark):
    expected = {
        "SP": "Sudeste", "RJ": "Sudeste", "MG": "Sudeste", "ES": "Sudeste",
        "PR": "Sul", "SC": "Sul", "RS": "Sul",
        "AC": "Norte", "AP": "Norte", "AM": "Norte", "PA": "Norte", "RO": "Norte", "RR": "Norte", "TO": "Norte",
        "AL": "Nordeste", "BA": "Nordeste", "CE": "Nordeste", "MA": "Nordeste", "PB": "Nordeste",
        "PE": "Nordeste", "PI": "Nordeste", "RN": "Nordeste", "SE": "Nordeste",
        "DF": "Centro-Oeste", "GO": "Centro-Oeste", "MT": "Centro-Oeste", "MS": "Centro-Oeste",
        "XX": None, "sp": None, None: None,
    }
    df = spark.createDataFrame([(s,) for s in expected], "state string")
    assert {r[0]: r[1] for r in df.select("state", region_of(F.col("state"))).collect()} == expected
