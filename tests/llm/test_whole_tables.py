"""Base spans of whole tables against plain loops, and texts with very many matches."""

import hashlib
import re
import time

from pyspark.sql import functions as F

from renown.llm import pii, secret_scan, suffix_dedup
from renown.session import ensure_checkpoint_dir

DOCS = "/root/testdata/sf0.001/documents.parquet"


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def luhn(digits):
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in twice) % 10 == 0


def personal(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15))
    return [(k, m.start(), m.end()) for k, p, good in kinds for m in re.finditer(p, text) if good(m.group())]


def secrets(text):
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def test_personal_data_of_every_document(spark):
    docs = spark.read.parquet(DOCS)
    want = {r.doc_id: personal(r.text or "") for r in docs.collect()}
    got = pii.personal_data_report(docs).collect()
    assert len(got) == len(want) and sum(map(len, want.values())) > 5
    for r in got:
        assert r.base_sha256 == digest(want[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want[r.doc_id]) for k in pii.KINDS]
        assert {f"{k}:{s}:{e}" for k, s, e in want[r.doc_id]} <= set(r.spans.split(","))


def test_secrets_of_every_document(spark):
    docs = spark.read.parquet(DOCS.replace("sf0.001", "sf0.01"))  # the smallest table has none
    want = {r.doc_id: secrets(r.text or "") for r in docs.collect()}
    got = secret_scan.secret_report(docs).collect()
    assert len(got) == len(want) and any(want.values())
    assert all(r.base_sha256 == digest(want[r.doc_id]) for r in got)


def test_texts_with_very_many_matches(spark):
    text = " ".join(f"10.{i % 256}.{i // 256}.7" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, "a@b.example.com")], "doc_id long, text string")
    began = time.time()
    rows = {r.doc_id: r for r in pii.personal_data_report(docs).collect()}
    assert rows[1].n_ip == 20_000 and rows[1].base_sha256 == digest(personal(text)) and rows[2].n_email == 1
    assert time.time() - began < 60


def test_redact_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "x a@b.example.com y", "keep", "too", 5), (2, None, None, None, None)],
                                 "doc_id long, text string, _spans string, _found0 string, _cut0 int")
    rows = pii.redact(docs).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, "x [EMAIL] y", "keep", "too", 5), (2, None, None, None, None)]


def test_a_secret_is_no_word_of_itself(spark):
    rows = [(i, f"plain words of the corpus number{i % 9} and more of them") for i in range(200)]
    rows += [(200, "login: wqzkxjvbpfmthd"), (201, "pwd: bfhqzvkxwj"), (202, "password: corpuswordsplain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [rows[r.doc_id][1][s.start:s.end] for s in r.spans] for r in secret_scan.scan_secrets(docs).collect() if r.spans}
    assert found == {200: ["wqzkxjvbpfmthd"], 201: ["bfhqzvkxwj"], 202: ["password: corpuswordsplain"]}
    assert secret_scan.value_words("pwd: ab-Cdef9ghi x", [(5, 16)]) == ["cdef", "ghi"]
    assert secret_scan.value_words("xdeadbeef", [(1, 9)]) == []


def test_suffix_dedup_leaves_one_table(spark):
    """Everything but the ranges of the result is deleted when the call returns."""
    import glob
    shared = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{shared}/suffix-*"))
    docs = spark.read.parquet(DOCS)
    out = suffix_dedup.repeats_report(docs)
    left = set(glob.glob(f"{shared}/suffix-*")) - before
    assert len(left) == 1 and "suffix-spans" in left.pop() and out.where("n_removed > 0").count() > 0
