import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from citeloom.llm import pii as p


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    text, out = text or "", []
    only = lambda x: re.sub("[^0-9]", "", x)
    checks = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(y) <= 255 for y in x.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda x: 14 <= len(only(x)) <= 19 and luhn(only(x))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 10 <= len(only(x)) <= 15),
    )
    for kind, (pattern, good) in enumerate(checks):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if good(m[0])]
    return ",".join(f"{p.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def base(column="pii_spans"):
    return p.render(F.filter(column, lambda s: s["kind"] < len(p.BASE_KINDS)))


def test_base_spans_equal_brute_force(spark):
    rnd = random.Random(5)
    parts = ["1", "2", "45", "4111 1111 1111 1111", "4111111111111111", " ", "-", ".", "@", "a", "b.c", "_", "+", "é", "😀", "(", ")", "255", "256", "0001", "x@y.zz", "\n", "+1 (482) 555-7163", "123-45-6789", "10.0.0.1"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += [None, "", "7" * 20_000, "a." * 8000 + "@", "12," * 9000 + "4111111111111111", "x@y.zz " * 3000, "+" * 5000, "1." * 9000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in p.find_pii(rows).select("doc_id", base().alias("b")).collect():
        assert r.b == brute(texts[r.doc_id]), texts[r.doc_id][:200]


def rendered(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    return [r.s for r in p.find_pii(rows).select("doc_id", p.render(F.col("pii_spans")).alias("s")).orderBy("doc_id").collect()]


def test_checksums_and_context(spark):
    got = rendered(spark, "DE89370400440532013000", "DE89 3704 0044 0532 0130 00.", "DE88370400440532013000", "no 123-45-6789", "SSN 123-45-6789", "SSN 000-45-6789")
    assert got == ["iban:0:22", "iban:0:27", "", "", "ssn:4:15", ""]
    rows = spark.createDataFrame([("pay card 4111111111111111",), ("4111111111111111",)], "text string")
    near, alone = [r.pii_spans[0].score for r in p.find_pii(rows).collect()]
    assert near > alone


def test_words_after_a_grouped_iban(spark):
    assert rendered(spark, "ES91 2100 0418 4502 0005 1332 EUR", "AT61 1904 3002 3457 3201 2024", "NO93 8601 1117 947 EUR") == ["iban:0:29", "iban:0:24", "iban:0:18"]
    assert rendered(spark, "ES91 2100 0418 4502 0005 1332 AT61 1904 3002 3457 3201") == ["iban:0:29,iban:30:54"]
    assert rendered(spark, "ES92 2100 0418 4502 0005 1332 EUR", "ES91 2100 0418 4502 0005 1332X") == ["", ""]


def test_redaction(spark):
    rows = [(1, "mail a@b.cc now", 15, "k"), (1, "mail a@b.cc now", 15, "k"), (None, None, None, None), (2, "clean", 5, "k"), (3, "a.b@10.0.0.1 é +1 (482) 555-7163", 32, "k"), (4, "", 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, pii_spans string")
    out = p.redact(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text, r.n_chars) for r in out.collect())
    assert got == [(0, None, None), (1, "mail [EMAIL] now", 16), (1, "mail [EMAIL] now", 16), (2, "clean", 5), (3, "[EMAIL] é [PHONE]", 17), (4, "", 0)]
    assert p.redact(docs.where("false")).count() == 0
    assert p.redact(docs.select("text")).columns == ["text"]


def test_query_equals_its_sql(same, middle):
    assert same(p.op10_pii, p.ORACLES["op10_pii"], middle) == 1000


def test_sql_on_odd_texts(spark, tmp_path, same):
    rnd = random.Random(8)
    parts = ["4111 1111 1111 1111", " ", ".", "@", "a", "é", "iban ", " DE89370400440532013000; ", " DE89 3704 0044 0532 0130 00; ", " DE88370400440532013000; ", "ssn ", "; 123-45-6789; ", "x@y.zz", "+1 (482) 555-7163", "call ", "10.0.0.1", "\n"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))) for i in range(400)] + [(400, None)]
    import pyarrow as pa
    import pyarrow.parquet as pq

    for t in "region nation customer supplier part orders lineitem events embeddings pages benchmark labels conversations".split():
        pq.write_table(pa.table({"x": [1]}), tmp_path / f"{t}.parquet")
    pq.write_table(pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}), tmp_path / "documents.parquet")
    assert same(p.op10_pii, p.ORACLES["op10_pii"], str(tmp_path)) == 401


def test_query(spark, middle):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{middle}/documents.parquet'").fetchall())
    frame = p.op10_pii(spark, middle)
    assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().executedPlan().toString())
    rows = frame.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(want.count(k + ":") for k in p.BASE_KINDS)
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
