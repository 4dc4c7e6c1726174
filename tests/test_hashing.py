import hashlib

from wardflow.functions.hashing import hash_utf8, hash_utf16le, hash_varchar


def test_digests_match_python(spark):
    vals = ["abc", "12345", "é漢字", "x" * 50, None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    rows = df.select(hash_utf8("s").alias("a"), hash_utf16le("s").alias("b"), hash_varchar("s").alias("c")).collect()
    for v, r in zip(vals, rows):
        if v is None:
            assert (r.a, r.b, r.c) == (None, None, None)
            continue
        assert r.a == hashlib.sha256(v.encode("utf-8")).hexdigest().upper()
        assert r.b == hashlib.sha256(v[:36].encode("utf-16-le")).hexdigest().upper()
        latin = "".join(ch if ord(ch) <= 0xFF else "?" for ch in v[:30])
        assert r.c == hashlib.sha256(latin.encode("latin-1")).hexdigest().upper()
        assert len(r.b) == 64 and r.b == r.b.upper()
