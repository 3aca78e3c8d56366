"""Surrogates: long texts, many names, scripts, formats and clashing names."""

import re

from pyspark.sql import functions as F

from quire.llm import surrogates as module
from quire.llm.surrogates import replace_personal_data


def replaced(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r["text"] for r in replace_personal_data(rows, "k").collect()}


def test_texts_of_a_million_characters(spark):
    """Forms that overflow the stack of a matcher that repeats groups by recursion."""
    texts = [
        "Mr " + "Ab " * 330_000,
        "Mr Smith said " + "a" * 1_000_000,
        "write to x@" + ".".join(["label"] * 200_000),
        "Mr " + " " * 100_000 + "x",
        "Mrs " + "A." * 50_000,
        "token=" + "é" * 100_000,
        "Mr " + "O'" * 50_000,
    ]
    out = replaced(spark, texts)
    assert len(out) == len(texts) and "Smith" not in out[1] and out[1].endswith("a" * 1_000_000)
    assert "Ab" not in out[0].split() and out[2].startswith("write to ") and "label" not in out[2]
    assert out[3] == texts[3] and "é" not in out[5]


def test_names_do_not_run_out(spark, monkeypatch):
    """Three syllables give 81 names of the first length; 600 parts still get 600 names."""
    monkeypatch.setattr(module, "LATIN", ["ba", "ko", "mi"])
    n = 600
    names = ["".join("abcdefghij"[int(d)] for d in str(1000 + i)) for i in range(n)]
    entities = spark.createDataFrame([(kind, name) for kind in ("male", "female") for name in names], "type string, canon string")
    rows = module.surrogates(entities, "k").collect()
    assert len({(r["type"], r["surrogate"]) for r in rows}) == 2 * n


def test_names_keep_their_script(spark):
    texts = ["Mr Παπαδόπουλος ήρθε", "г-н Иванов", "Mr 田中 spoke", "Mrs שרה left", "Mr John Smith"]
    out = replaced(spark, texts)
    for i, script in enumerate(("Ͱ-Ͽ", "Ѐ-ӿ", "一-鿿", "֐-׿", "A-Za-z")):
        name = out[i].split()[1]
        assert re.fullmatch(f"[{script}]+", name) and name != texts[i].split()[1]
    assert out[2].endswith(" spoke") and out[0].endswith(" ήρθε")


def test_secrets_and_addresses_keep_their_form(spark):
    out = replaced(spark, ["password=aB3$xyZ1 then", "a.b-c1@corp.example x", "password=****** y"])
    assert re.fullmatch(r"password=[a-z][A-Z]\d\$[a-z]{2}[A-Z]\d then", out[0])
    assert "aB3$xyZ1" not in out[0]
    assert re.fullmatch(r"[a-z]\.[a-z]-[a-z]\d@mail\.example\.net x", out[1])
    assert "******" not in out[2]


def test_any_column_name_is_kept(spark):
    rows = [(1, "Mr Smith", "a", "b", "c", "d", "e", "f")]
    names = ["doc_id", "text", "_text", "_list", "_row", "_found", "N_ENTITIES", "_n_found"]
    out = replace_personal_data(spark.createDataFrame(rows, names), "k")
    assert out.columns == ["doc_id", "text", "_text", "_list", "_row", "_found", "_n_found", "n_entities"]
    r = out.first()
    assert (r["_text"], r["_list"], r["_row"], r["_found"], r["_n_found"], r["n_entities"]) == ("a", "b", "c", "d", "f", 1)
    alone = replace_personal_data(spark.createDataFrame([("Mr Smith",), (None,)], ["text"]), "k")
    assert alone.columns == ["text", "n_entities"] and alone.filter(F.col("text").isNull()).first()["n_entities"] == 0
    assert replace_personal_data(spark.createDataFrame([], "text string, _list int"), "k").collect() == []


def test_entities_of_a_table_stay_distinct_and_coreferent(spark):
    """Every pair of mentions is equal after replacement if and only if it was before."""
    people = [f"{a}{b}" for a in ("An", "Be", "Cor", "Da") for b in ("ton", "ver", "lin")]
    texts = [f"Mr {p} wrote to {p.lower()}@corp{i % 3}.example from 10.0.{i}.7" for i, p in enumerate(people)] * 2
    out = replaced(spark, texts)
    of = re.compile(r"Mr (\w+) wrote to (\S+) from (\S+)")
    for kind in (1, 2, 3):
        pairs = {(of.match(t)[kind], of.match(out[i])[kind]) for i, t in enumerate(texts)}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
        assert not {a for a, _ in pairs} & {b for _, b in pairs}
