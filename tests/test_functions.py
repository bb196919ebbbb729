"""Cleaning rules on the worked cases of FIXTURES.md."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadenza.functions import address, catalog, dates
from cadenza.functions.heat import heat_index


def evaluate(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = rows.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()
    return [row.out for row in found]


def check(spark, cases, column):
    assert evaluate(spark, [case for case, _ in cases], column) == [want for _, want in cases]


def test_album(spark):
    none = "暂无专辑"
    cases = [
        ('[{"name":"A","id":1}]', "A"),
        ("X《红》Y", "《红》"),
        ("abc", none),
        ("", none),
        ("[]", none),
        ("[1]", none),
        ('{"name":"A"}', none),
        ("》x《", none),
        ('[{"id":1}]', None),
        (None, none),
        ("》《红》", none),
    ]
    check(spark, cases, catalog.album_name)


def test_singers(spark):
    texts = {
        '[{"name":"A","id":1},{"name":"B","id":2}]': ("A", "1", "B", "2"),
        '[{"name":"A"}]': ("A", None, "", ""),
        "[]": ("", "", "", ""),
        "bad": ("", "", "", ""),
        None: ("", "", "", ""),
        '[{"name":"A","id":1},{"id":"x"}]': ("A", "1", None, "x"),
    }
    fields = [(0, "name"), (0, "id"), (1, "name"), (1, "id")]
    for place, (position, field) in enumerate(fields):
        check(
            spark,
            [(text, want[place]) for text, want in texts.items()],
            lambda c, p=position, f=field: catalog.singer_field(c, p, f),
        )


def test_company(spark):
    cases = [('{"name":"C"}', "C"), ("{}", None), ("", "乐心曲库"), ("bad", "乐心曲库"),
             (None, "乐心曲库"), ('[{"name":"C"}]', "乐心曲库")]
    check(spark, cases, catalog.company_name)


def test_product_types(spark):
    cases = [("[8.0,9.0]", [8, 9]), ("[8.9]", [8]), ("[-1.5]", [-1]), ("  ", []), ("", []),
             ("[]", []), (None, []), ("[8.0,]", [8]), ("7", [7])]
    check(spark, cases, catalog.product_types)


def test_time_text(spark):
    cases = [
        ("2020-01-02 03:04:05", "2020-01-02 03:04:05"),
        ("2020-01-02 03:04:05.0", "2020-01-02 03:04:05"),
        ("2020-1-2 3:4:5", "2020-01-02 03:04:05"),
        ("2020-13-02 03:04:05", "2021-01-02 03:04:05"),
        ("2020-02-30 25:00:00", "2020-03-02 01:00:00"),
        ("1577934245000", "2020-01-02 03:04:05"),
        ("1.577934245E12", "2020-01-02 03:04:05"),
        ("2020", "1970-01-01 00:00:02"),
        ("9" * 30, ""),
        ("x", ""),
        ("", ""),
        (None, ""),
    ]
    check(spark, cases, dates.normalise_time)


def test_padded_time(spark):
    epoch = "19700101000000"
    cases = [("20200101", "20200101000000"), ("20200101123000", "20200101123000"),
             ("2020", epoch), ("", epoch), (None, epoch), ("202001011230001", epoch)]
    check(spark, cases, dates.pad_time)


ADDRESSES = [
    ("内蒙古自治区呼和浩特市新城区", "内蒙古", "呼和浩特"),
    ("宁夏回族自治区银川市兴庆区", "宁夏", "银川"),
    ("广西壮族自治区南宁市青秀区", "广西", "南宁"),
    ("西藏自治区拉萨市城关区", "西藏", ""),
    ("新疆维吾尔自治区乌鲁木齐市天山区", "新疆", "乌鲁木齐"),
    ("新疆维吾尔自治区伊犁哈萨克自治州霍城县", "新疆", "伊犁哈萨克自治"),
    ("新疆维吾尔自治区阿克苏地区温宿县", "新疆", "阿克苏地"),
    ("新疆维吾尔自治区", "新疆", ""),
    ("北京市朝阳区", "北京", "朝阳"),
    ("上海市崇明县", "上海", ""),
    ("天津市和平区", "天津", "和平"),
    ("重庆市渝中区解放碑", "重庆", "渝中"),
    ("重庆市云阳县", "重庆", "云阳"),
    ("重庆市", "重庆", ""),
    ("某区重庆市渝中区", "重庆", ""),
    ("湖南省长沙市岳麓区", "湖南", "长沙"),
    ("云南省大理白族自治州祥云县", "云南", "大理白族自治"),
    ("青海省海北州门源县", "青海", "海北"),
    ("内蒙古自治区阿拉善盟", "内蒙古", ""),
    ("somewhere", "", ""),
    ("", "", ""),
    (None, "", ""),
]


def test_address(spark):
    check(spark, [(a, p) for a, p, _ in ADDRESSES], address.province)
    check(spark, [(a, c) for a, _, c in ADDRESSES], address.city)


def test_repair_keeps_known_values(spark):
    row = spark.createDataFrame([("湖北", "null", "湖南省长沙市")], "p string, c string, a string")
    found = row.select(
        address.repair_province(F.col("p"), F.col("a")), address.repair_city(F.col("c"), F.col("a"))
    ).first()
    assert tuple(found) == ("湖北", "长沙")


@pytest.mark.parametrize(
    "counts, want",
    [
        ((10, 0, 70, 20, 0, 0, 300, 30, 0, 0), (14.605670, 44.509094, 49.506225)),
        ((1, 0, 1, 0, 0, 0, 1, 0, 0, 0), (1.220428, 0.045293, 0.002731)),
        ((5, 2, 14, 6, 7, 3, 60, 9, 30, 4), (10.846638, 17.413767, 20.785010)),
    ],
)
def test_heat_index(spark, counts, want):
    s1, l1, s7, p7, l7, q7, s30, p30, l30, q30 = map(F.lit, counts)
    found = spark.range(1).select(
        F.round(heat_index(s1, l1), 6).alias("a"),
        F.round(heat_index(s7, l7, 7, p7, q7), 6).alias("b"),
        F.round(heat_index(s30, l30, 30, p30, q30), 6).alias("c"),
    )
    assert tuple(found.first()) == want


def test_shift_day():
    assert dates.shift_day("20240301", -1) == "20240229"
    assert dates.shift_day("20240130", -30) == "20231231"
