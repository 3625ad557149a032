from __future__ import annotations

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tempora.functions import names
from tempora.store import Store


def plain(name, special, stop, fallback):
    text = unicodedata.normalize("NFKD", "".join(special.get(c, c) for c in name.lower()))
    every = set(re.findall("[a-z0-9]+", "".join(c for c in text if not unicodedata.combining(c))))
    return every - set(stop) or (every if fallback else set())


NAMES = ["İstanbul Başakşehir", "FC Botoșani", "Köln", "Köln", "Malmö FF", "Bodø/Glimt", "Fæ ð", "ﬁnland", "Ｆｕｌｌ", "FC", "", "Đurđevac", "ǆ Ǆ", "Åland №5", "Union St.-Gilloise", "ŁKS Łódź"]


def test_names_fold_as_their_decomposition(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES] + [(None,)], "n string").select("n", names.tokens(F.col("n")).alias("odds"), names.tokens(F.col("n"), names.STOP_RANKING, False).alias("ranking"))
    for r in rows.collect():
        if r["n"] is not None:
            assert set(r["odds"]) == plain(r["n"], names.SPECIAL, names.STOP_ODDS, True), r["n"]
            assert set(r["ranking"]) == plain(r["n"], names.SPECIAL_RANKING, names.STOP_RANKING, False), r["n"]


def test_a_version_is_published_by_one_rename(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    first = store.publish({"t": spark.range(3)})
    (tmp_path / "s" / "pointers" / "half.tmp").write_text("broken")  # a run that ended before its rename
    assert store.current() == first and store.read("t").count() == 3
    second = store.publish({"u": spark.range(2)})
    assert store.current() == second != first and store.read("t").count() == 3 and store.read("u").count() == 2
    with pytest.raises(FileNotFoundError):
        store.read("v")
