"""Goldens of the column functions."""

import pytest
from pyspark.sql import functions as F

from foliant.functions import text as T


def value(spark, column, **given):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in given.items()])
    return row.select(column.alias("v")).first()["v"]


def test_normalised_keys(spark):
    t = F.col("t")
    assert value(spark, T.normalised(t), t="第 1 章：《起点》！") == "第1章起点！"
    assert value(spark, T.normalised(t, T.QC_DROPS), t="# 第*一*章") == "第一章"
    assert value(spark, T.normalised(t, T.VERIFY_DROPS), t="真的?") == "真的?"
    assert value(spark, T.normalised(F.lit(None).cast("string"))) == ""
    assert value(spark, T.stripped(t), t="　 甲  ") == "甲"


@pytest.mark.parametrize("text, expected", [("19. 起 点", True), ("3.一", False), ("100.标题", False), ("3.14159", True)])
def test_numbered_chapter(spark, text, expected):
    assert value(spark, T.is_numbered_chapter(F.col("t")), t=text) is expected


@pytest.mark.parametrize("text, family", [("其十一", "其"), ("第十二", "第"), ("第一章", None), ("其 二", "其")])
def test_ordinal_family(spark, text, family):
    assert value(spark, T.ordinal_family(F.col("t")), t=text) == family


@pytest.mark.parametrize("text, bad", [("《甲（乙", ["《》", "（）"]), ("“甲", []), ("“甲“乙”", ["“”"]), ("", [])])
def test_pair_imbalance(spark, text, bad):
    assert value(spark, T.pair_imbalance(F.col("t")), t=text) == bad


@pytest.mark.parametrize("text, local", [("中,文;字", "中，文；字"), ("A,中", "A,中"), ("中,文,字", "中，文，字"), ("中!文?字:末", "中！文？字：末")])
def test_localised_punctuation(spark, text, local):
    once = value(spark, T.localised_punctuation(F.col("t")), t=text)
    assert once == local
    assert value(spark, T.localised_punctuation(F.col("t")), t=once) == local


@pytest.mark.parametrize("text, part, n", [("aaa", "aa", 1), ("甲乙甲", "甲", 2), ("甲", "", 2), ("", "甲", 0)])
def test_occurrences(spark, text, part, n):
    assert value(spark, T.occurrences(F.col("t"), F.col("p")), t=text, p=part) == n


@pytest.mark.parametrize("n, ok", [(7, False), (8, True), (20, True), (21, False)])
def test_ratio_guard(spark, n, ok):
    assert value(spark, T.within_ratio(F.col("o"), F.col("n")), o="一" * 10, n="二" * n) is ok


@pytest.mark.parametrize("shape, n, expected", [((0.55, 0.1, 0.95), 2, 0.75), ((0.55, 0.1, 0.95), 4, 0.95), ((0.5, 0.15, 0.9), 3, 0.9), ((0.5, 0.15, 0.85), 2, 0.8)])
def test_confidence(spark, shape, n, expected):
    assert value(spark, T.confidence(F.col("n"), *shape), n=n) == pytest.approx(expected)


def test_misc(spark):
    assert value(spark, T.json_in_prose(F.col("t")).cast("string"), t='text {"a":1} tail') is not None
    assert value(spark, T.json_in_prose(F.col("t")).isNull(), t="{a") is True
    assert value(spark, T.without_superscript(F.col("t")), t="甲$^{①}$") == "甲①"
    assert value(spark, T.without_star_escape(F.col("t")), t="丙。\\*") == "丙。*"
    assert value(spark, T.expanded_box(F.array(*[F.lit(x) for x in (0.0, 0.4, 1.0, 0.6)]))) == pytest.approx([0.0, 0.37, 1.0, 0.63])
    assert value(spark, T.without_toc_number(F.col("t")), t="丙篇……12") == "丙篇"
    assert value(spark, T.adds_traditional(F.col("o"), F.col("n")), o="国家", n="國家") is True
