from datetime import datetime
from decimal import Decimal

import pytest

from cairn.plans.gold import ft_agg_product_day
from cairn.plans.incremental import change_daily, create_daily, read_daily
from cairn.session import scratch_dir
from cairn.sources.tables import create_layers, read_table
from tests.conftest import rows

FACT = "ProductKey long, OrderDateKey timestamp, OrderQty int, LineTotal decimal(38,6)"
D1, D2, D3 = datetime(2020, 1, 1, 5), datetime(2020, 1, 2), datetime(2020, 3, 31, 23)


def sale(product, day, quantity=1, amount="2.5"):
    return product, day, quantity, Decimal(amount)


SALES = [
    sale(1, D1), sale(1, D1, 2), sale(1, D2), sale(2, D1, 3, "-1"), sale(2, D3), sale(None, D1), sale(1, None), sale(None, None, 4),
]


@pytest.fixture
def state(spark, request):
    name = f"incremental_{abs(hash(request.node.name)) % 10**8}"
    create_layers(spark, {name: scratch_dir(spark, "db")})
    return f"{name}.state"


@pytest.fixture
def product(spark):
    return spark.createDataFrame(
        [(1, "one", "c", "s"), (3, "three", "c", "s")],
        "ProductKey long, ProductName string, CategoryName string, SubcategoryName string",
    )


@pytest.mark.parametrize(
    "removed, added",
    [
        ([], [sale(1, D1, 7), sale(9, D3), sale(None, None)]),
        ([sale(1, D1), sale(2, D3)], []),  # a group with other sales, and the last sale of a day
        ([sale(1, D2), sale(None, D1)], [sale(1, D3, 5, "9.999999"), sale(None, D1, 2)]),
        ([sale(1, None), sale(None, None, 4)], [sale(1, D1)]),
        ([sale(2, D1, 3, "-1")], [sale(2, D1, 1, "1"), sale(2, D1, 1, "-1")]),  # sums of zero stay
        (SALES, []),
        ([], []),
    ],
)
def test_changed_state_equals_the_whole_computation(spark, state, product, removed, added):
    create_daily(spark.createDataFrame(SALES, FACT), state)
    left = list(SALES)
    for row in removed:
        left.remove(row)
    frames = [spark.createDataFrame(r, FACT) for r in (removed, added, left + added)]
    months = {r[1] and r[1].month for r in removed + added}
    assert change_daily(spark, state, *frames[:2]) == len(months)
    want = ft_agg_product_day(frames[2], product)
    got = read_daily(spark, state, product)
    assert got.schema.simpleString() == want.schema.simpleString() and rows(got) == rows(want)


def test_other_months_keep_their_files(spark, state):
    create_daily(spark.createDataFrame(SALES, FACT).coalesce(1), state)
    before = set(read_table(spark, state).inputFiles())
    change_daily(spark, state, spark.createDataFrame([], FACT), spark.createDataFrame([sale(1, D3)], FACT))
    after = set(read_table(spark, state).inputFiles())
    assert len(before) == 3 and len(before & after) == 2
