"""Fill-in-middle against a plain loop over units."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F
from tanisight.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [None, "", " ", "\n\t ", "one", " lead and trail \n", "a b   c\x1cd", "has <P> in it and more words", "<M>", "日本 語\r\n字 😀 é",
         "ends with < and <S", "x <P y <S z <M w", "same text here", "same text here", " ".join(f"w{i}" for i in range(30000))]


def expected(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_every_text_under_many_ids(spark):
    rows = [(100 * k + i, t, "x", -1) for k in range(12) for i, t in enumerate(TEXTS)] + [(None, "null id of a text", "x", -1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, n long").repartition(4)
    got = infill.transform(docs).withColumn("restored", infill.restore(F.col("output"), F.col("form"))).collect()
    found = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got]
    assert sorted(found, key=repr) == sorted(((i, *expected(i, t)) for i, t, *_ in rows), key=repr)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    texts = {i: t or "" for i, t, *_ in rows}
    assert all(r.restored == texts[r.doc_id] for r in got)
    assert infill.transform(docs.limit(0)).count() == 0


def test_one_match_holds_all_ends():
    text = "  a bb\tccc \n"
    assert infill.UNITS.fullmatch(text).ends(1) == [3, 6, 10, 12]
    assert infill.UNITS.fullmatch("").ends(1) == []
    assert infill.cut(1, "", 42, 100, 80)[:2] == (0, "plain")


def test_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert "Exchange" not in infill.transform(docs)._jdf.queryExecution().executedPlan().toString()
