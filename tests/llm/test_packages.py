"""Archives in packages, spelling variants and the manifest, against plain Python."""

import gzip
import hashlib
import io
import random
import zipfile
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratiform.llm import merkle, warc
from stratiform.llm.spelling import count_words, group_variants, runs_of

# ---------------------------------------------------------------- archives

PAGES = "page_id long, url string, html string, headers string"


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RANGE", 4000)
    big = "x\r\n\r\nWARC/1.1 é" * 300_000
    rows = [(3, "http://a/", "same", "z"), (1, None, "same", "z"), (1, "http://b/\n\té", "same", None), (None, "http://c/", "same", "z"), (4, "", None, "z"), (2, "u", "", "z"), (None, "u", "alone", None), (9, "u" * 9000, big, "z")]
    rows += [(100 + k, f"http://h/{k}", f"page {k}", "z") for k in range(200)]
    folder = f"file://{tmp_path}/out"
    packages = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), folder)
    for r in packages.collect():
        with zipfile.ZipFile(r["path"].removeprefix("file://")) as z:  # as another reader sees it
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {0}
            assert z.read(warc.ARCHIVE)[:2] == b"\x1f\x8b" and len(z.read(warc.INDEX).splitlines()) == r["pages"]
    found = warc.read_archives(packages).filter("record_type != 'warcinfo'").collect()
    got = sorted((r["headers"].get("page-id", ""), r["record_type"], r["headers"].get("refers-to-page-id", ""), r["headers"]["warc-target-uri"], r["payload"].decode()) for r in found)
    uri = {None: "about:blank", "": "about:blank", "http://b/\n\té": "http://b/%0A%09%C3%A9"}
    first = {"same": 1, "": 2}
    want = []
    for page_id, url, html, _ in rows:
        html = html or ""
        revisit = html in first and page_id != first[html]
        want.append(("" if page_id is None else str(page_id), "revisit" if revisit else "response", str(first[html]) if revisit else "", uri.get(url, url), "" if revisit else html))
    assert got == sorted(want)
    assert {r["http"]["content-length"] for r in found if r["headers"].get("page-id") == "9"} == {str(len(big.encode()))}
    assert all(r["headers"]["warc-payload-digest"] == "sha1:" + warc._digest(r["payload"]) for r in found if r["record_type"] == "response")
    none = warc.write_archives(spark.createDataFrame([], PAGES), folder)
    assert none.count() == 0 and warc.read_archives(none).count() == 0
    few = warc.write_archives(spark.createDataFrame(rows[:6], PAGES), folder, least=1)
    kinds = {(r["headers"].get("page-id"), r["record_type"]) for r in warc.read_archives(few).collect()}
    assert {("4", "response"), ("2", "response"), ("3", "revisit")} <= kinds


def _members(data: bytes):
    file = pa.BufferReader(data)
    return {m.name: (m.method, warc._at(file, m.start, m.size)) for m in warc.directory(file)}


@pytest.mark.parametrize("limit", [1 << 31, 5])
def test_directories(monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3 if limit == 5 else 65_535)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.comment = b"mark PK\5\6 in the comment and more than twenty-two bytes"
        for k in range(5):
            z.writestr(zipfile.ZipInfo(f"ü/{k}"), b"body" * k)
        z.writestr("packed", b"a" * 1000, zipfile.ZIP_DEFLATED)
    assert (b"PK\6\6" in out.getvalue()) == (limit == 5)
    found = _members(out.getvalue())
    assert {n: b for n, (m, b) in found.items() if m == 0} == {f"ü/{k}": b"body" * k for k in range(5)}
    assert zlib.decompress(found["packed"][1], -15) == b"a" * 1000
    for broken in (b"", b"PK", out.getvalue()[:-30], b"x" * 100):
        with pytest.raises(ValueError):
            _members(broken)


def test_other_packages(spark, tmp_path):
    """Plain archives, archives without an index, packed indexes and archives that can't be read by ranges."""
    plain = b"".join(zlib.decompress(warc.page_record(k, b"u", b"p%d" % k, None, "2024"), 31) for k in range(50))
    gz = [warc.page_record(k, b"u", b"q%d" % k, None, "2024") for k in range(50, 60)]
    lines = b"".join(b'u 2024 {"offset": %d, "length": %d, "filename": "b.warc.gz"}\n' % (sum(map(len, gz[:k])), len(gz[k])) for k in range(9, -1, -2))
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as z:
        z.writestr("archive/a.warc", plain)
        z.writestr("archive/b.warc.gz", b"".join(gz))
        z.writestr("archive/c.warc.gz", b"")
        z.writestr("indexes/b.cdx.gz", gzip.compress(lines[:40]) + gzip.compress(lines[40:]), zipfile.ZIP_DEFLATED)
    df = spark.createDataFrame([(f"file://{tmp_path}/a.wacz",)], "path string")
    assert sorted(bytes(r["payload"]).decode() for r in warc.read_archives(df).collect()) == sorted([f"p{k}" for k in range(50)] + [f"q{k}" for k in range(51, 60, 2)])
    with zipfile.ZipFile(tmp_path / "c.wacz", "w") as z:
        z.writestr("archive/a.warc", plain, zipfile.ZIP_DEFLATED)
    with pytest.raises(Exception, match="archive/a.warc is compressed within the package"):
        warc.read_archives(spark.createDataFrame([(f"file://{tmp_path}/c.wacz",)], "path string")).collect()


# ---------------------------------------------------------------- spelling


def _near(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_variants(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(400)} | {"", "aaaaaaa", "aaaaaa", "aaaaaaaa", "𝕏a", "𝕐a"}
    counts = {w: rng.choice([1, 1, 2, 5, 10, 20, 200, 2000]) for w in words}
    got = {r["word"]: tuple(r)[1:] for r in group_variants(spark.createDataFrame(list(counts.items()), "word string, n int").repartition(3)).collect()}
    form = {}
    for w, n in counts.items():
        near = [v for v in words if _near(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form[w] = (best if best is not None and counts[best] >= 10 * n else None, n, len(near))
    for w, (f, n, n_near) in form.items():
        root = w
        while form[root][0] is not None:
            root = form[root][0]
        assert got[w] == (f, root, n, n_near, counts[f] if f is not None else None), w
    assert len(got) == len(words)
    assert group_variants(spark.createDataFrame([], "word string, n long")).collect() == []
    odd = group_variants(spark.createDataFrame([("a\0b", 5), ("ab", 50)], "word string, n long")).collect()
    assert {r["word"]: r["n_near"] for r in odd} == {"a\0b": 0, "ab": 0}


def test_words_of_documents(spark):
    long = "Übermäßig " * 50_000
    rows = [(1, "Straßen-ABCDEFG abcdefg abcdef", "x"), (1, "Straßen-ABCDEFG abcdefg abcdef", "x"), (None, None, None), (2, "", "x"), (3, long, "x"), (4, "ÀBCDEFG àbcdefg", "x")]
    runs = runs_of(spark.createDataFrame(rows, "doc_id long, text string, run string").select("doc_id", "text"))
    got = {r["word"]: r["n"] for r in count_words(runs, F.col("run")).collect()}
    assert got == {"straßen": 2, "abcdefg": 4, "Übermäßig": 50_000}


# ---------------------------------------------------------------- manifest


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(level: list[str]) -> tuple[str, list[list[tuple[bool, str]]]]:
    paths: list[list[tuple[bool, str]]] = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        for k, i in enumerate(at):
            paths[k].append((i % 2 == 1, level[i ^ 1] if i ^ 1 < len(level) else ""))
        level = [_h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest(spark, monkeypatch, bits):
    monkeypatch.setattr(merkle, "BITS", bits)
    monkeypatch.setattr(merkle, "BLOCK", 1 << bits)
    rng = random.Random(bits)
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, "", "en", "é", "z", "zz"]), rng.choice([None, "", "text é"]), "leaf") for _ in range(150)] + [(7, "en", "same", "leaf")] * 40 + [(1, "one", "x" * 300_000, "leaf")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, leaf string").repartition(5)
    out = merkle.manifest(df, "lang", ["doc_id"], ["doc_id", "lang", "text"], {"doc_id": F.col("doc_id"), "mark": F.col("leaf")})
    out = out.withColumn("folded", merkle.folded(F.col("leaf"), F.col("path"))).withColumn("proof", merkle.proof_hash(F.col("path")))
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups: dict[bytes | None, list] = {}
    for d, lang, t, _ in rows:
        groups.setdefault(None if lang is None else lang.encode(), []).append((d is not None, d or 0, _h(field(d), field(lang), field(t))))
    order = sorted(groups, key=lambda g: (g is not None, g or b""))
    trees = [_tree([leaf for _, _, leaf in sorted(groups[g])]) for g in order]
    root, upper = _tree([t[0] for t in trees])
    want = []
    for g, (subroot, paths), above in zip(order, trees, upper):
        for (has, d, leaf), path in zip(sorted(groups[g]), paths):
            want.append((str(d) if has else "", leaf, subroot, root, _h(*(s for _, s in path + above)), [tuple(s) for s in path + above]))
    got = out.collect()
    assert {(r["folded"], r["mark"]) for r in got} == {(root, "leaf")}
    assert sorted(("" if r["doc_id"] is None else str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof"], [tuple(s) for s in r["path"]]) for r in got) == sorted(want)


def test_small_manifests(spark):
    df = spark.createDataFrame([(1, "a")], "id long, kind string")
    one = merkle.manifest(df, "kind", ["id"], ["id"]).first()
    assert one["leaf"] == one["subroot"] == one["root"] == _h("1:1") and one["path"] == []
    assert merkle.manifest(df.limit(0), "kind", ["id"], ["id"]).collect() == []
    changed = merkle.manifest(df.union(spark.createDataFrame([(2, "a")], "id long, kind string")), "kind", ["id"], ["id"])
    assert [r["x"] for r in changed.select(merkle.folded(F.lit(_h("no")), F.col("path")).alias("x"), "root").filter("x = root").collect()] == []
