"""Vectors, URLs, conversations and the pipeline."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stratiform.llm import ann, chat
from stratiform.llm.queries import SPOOF
from stratiform.llm.url_lists import HOST_RULES, URL_RULES
from stratiform.llm.url_rules import judge, parse_rules, pattern_rule, read_rules

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_nearest_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 60)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16))
    x[700:800] = x[700]
    rows = [(i, [float(v) for v in x[i]], "c") for i in range(len(x))]
    odd = [(5000, None, "c"), (5100, [0.0] * 16, "c"), (5200, [float("nan")] * 16, "c"), (5300, [None] + [1.0] * 15, "c"), (5400, [1.0] * 3, "c"), (100, rows[100][1], "c")]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score string")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(got) == list(range(0, 1500, 100))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        hits += len({v for v, _ in found.values()} & set(best))
        assert sorted(found) == list(range(1, 11))
        for v, s in found.values():
            assert s == d[v]
    assert hits >= 0.9 * 10 * len(got)
    assert [v for v, _ in (got[700][k] for k in range(1, 11))] == list(range(701, 711))
    assert ann.search(table.limit(0), F.lit(True)).collect() == []
    few = ann.search(table.filter("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert len(few) == 2
    twice = spark.createDataFrame([(0, [9.0, 1.0]), (0, [1.0, 1.0]), (1, [1.5, 1.0]), (2, [8.0, 1.0])], "vec_id long, embedding array<double>")
    for df in (twice, twice.orderBy(F.desc("vec_id")), twice.repartition(3)):  # of a repeated query id the least vector asks
        assert [tuple(r) for r in ann.search(df, F.col("vec_id") == 0, k=2).orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 7.0)]


def test_recall_of_the_registered_query(spark):
    """op1 on the table `embeddings` as it is, against all distances; measured 1.0, at least 0.9 is asked for."""
    from stratiform.llm.queries import op1_ann

    rows = [r for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect() if r["embedding"] is not None]
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    ids, x = ids[(x != 0).any(axis=1)], x[(x != 0).any(axis=1)]
    got = {}
    for r in op1_ann(spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    asked = [i for i in ids.tolist() if i % 100 == 0]
    hits = 0
    for q in asked:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        best = [i for i in ids[np.lexsort((ids, d))].tolist() if i != q][:10]
        hits += len(got[q] & set(best))
    assert sorted(got) == sorted(asked) and hits >= 0.9 * 10 * len(asked)


@pytest.mark.parametrize("inline", [500, 0])
def test_urls(spark, inline):
    want = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "abc": ("", "", None, "allow"), "http://A.Com": ("a.com", "", None, "allow"), "http://A.Com/": ("a.com", "/", "com/", "allow"),
        "http://x.com?a=/b": ("x.com", "", None, "allow"), "https://a.b.net/es/3?x#y": ("a.b.net", "/es/3", "net/es/", "block"), "http://www.example.com/en/x#?": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"), "http://example.com/EN/": ("example.com", "/EN/", "com/", "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "http://xnet/es/": ("xnet", "/es/", None, "allow"), "http://ads-track.example.org/x": ("ads-track.example.org", "/x", None, "block"), "http://mads-track.example.org/x": ("mads-track.example.org", "/x", None, "allow"),
    }
    df = spark.createDataFrame([(u, "keep", "old") for u in want] + [("abc", "keep", "old")], "url string, other string, verdict string")
    out = judge(df, URL_RULES, inline=inline).collect()
    assert len(out) == len(want) + 1
    for r in out:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == want[r["url"]] and r["other"] == "keep"
    assert judge(df.limit(0), URL_RULES, inline=inline).collect() == []


@pytest.mark.parametrize("inline", [500, 0])
def test_patterns_inside_longer_runs(spark, inline):
    want = {
        "http://bestcasino.net/promo/": "block", "http://x.mycasino.org/a/bonus/": "block", "http://casino.org/promo/": "block", "http://casinos.org/promo/": "allow", "http://x.org/casino.y/promo/": "allow",
        "http://e.org/Xads-track.z": "block", "http://e.org/xads-track.z": "allow", "http://e.org/Afree-bets.z": "block", "http://e.org/Zcheap-pills.": "block", "http://e.org/éads-track.z": "block", "http://bestcasino.com/promo/": "allow",
    }
    rules = [pattern_rule("(^|[^a-z0-9])ads-track[.]", ("ads", "track")), pattern_rule("(^|[^a-z0-9])free-bets[.]", ("free", "bets")), pattern_rule("(^|[^a-z0-9])cheap-pills[.]", ("cheap", "pills")), pattern_rule("^[^/]*casino[.].*/(promo|bonus)/", ("casino",))]
    df = spark.createDataFrame([(u,) for u in want], "url string")
    assert {r["url"]: r["verdict"] for r in judge(df, [*HOST_RULES, *rules], inline=inline).collect()} == want


def filter_matches(line, target):
    """Brute force: a filter line against host and path, by going through both."""
    body = line.removeprefix("@@")
    host_start, start = body.startswith("||"), body.startswith("|")
    body = body[2:] if host_start else body[1:] if start else body
    end = body.endswith("|")
    body = body[:-1] if end else body

    def fits(i, k):
        if k == len(body):
            return not end or i == len(target)
        if body[k] == "*":
            return any(fits(j, k + 1) for j in range(i, len(target) + 1))
        if body[k] == "^":
            if i == len(target):
                return fits(i, k + 1)
            return not (target[i].isascii() and (target[i].isalnum() or target[i] in "_.%-")) and fits(i + 1, k + 1)
        return i < len(target) and target[i] == body[k] and fits(i + 1, k + 1)

    host = target.split("/")[0]
    places = [0, *(i + 1 for i, c in enumerate(host) if c == ".")] if host_start else [0] if start else range(len(target) + 1)
    return any(fits(i, 0) for i in places)


@pytest.mark.parametrize("inline", [5_000, 0])
def test_filter_lines(spark, inline):
    """Two thousand lines with anchors, wildcards, separators and exceptions, and very long URLs, against brute force."""
    import random

    rng = random.Random(12)
    word = lambda: rng.choice(["abc", "track", "promo", "xyz1", "deal", "pills", "news", "cdn7"])
    lines = ["! a comment", "", "||track.abc^", "@@||news.", "|abc.", ".gif|", "promo*deal", "^xyz1^"]
    for i in range(2_000):
        body = f"{word()}{rng.choice(['.', '-', '/', '*', '^', ''])}{word()}{rng.randint(0, 400)}{rng.choice(['', '^', '/', '*z'])}"
        lines.append(rng.choice(["", "@@", "||", "|", "@@||"]) + body + rng.choice(["", "", "|"]))
    urls = []
    for i in range(300):
        host = ".".join(rng.choice([word(), f"{word()}{rng.randint(0, 400)}", f"{word()}-{word()}{rng.randint(0, 400)}"]) for _ in range(rng.randint(1, 3)))
        urls.append(f"http://{host}/" + "/".join(f"{word()}{rng.choice(['', '-', '.'])}{word()}{rng.randint(0, 400)}" for _ in range(rng.randint(0, 3))) + rng.choice(["", ".gif", "?q=track.abc"]))
    urls += ["http://" + "a" * 200_000 + "/track", "http://abc.org/" + "promo/" * 20_000 + "deal", "http://x/\u00e9track"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rules = read_rules(spark.createDataFrame([(line,) for line in lines], "value string"))
    assert len(rules) == 2_006 and rules == parse_rules("\n".join(lines))
    got = {r["url"]: r for r in judge(df, rules, inline=inline).collect()}
    for url in urls:
        target = got[url]["host"] + got[url]["path"]
        hits = [r for r in rules if len(target) < 10_000 and filter_matches(r.name, target)]
        want = "allow" if not hits or any(r.verdict == "allow" for r in hits) else "block"
        assert len(target) > 10_000 or got[url]["verdict"] == want, (url, hits)
    assert got[urls[-2]]["verdict"] == "block"


@pytest.mark.parametrize("inline", [5_000, 0])
def test_short_lines_and_options(spark, inline):
    """Lines that no long literal indexes, real lists' other kinds of lines, and an empty list."""
    skipped = {}
    lines = ["[Adblock Plus 2.0]", "/ad/", "||t.co^", "@@||ok.io^$document", "||x.", "example.org##.banner", "~a.b#@#.x", "||cdn.net^$third-party,script", "-a-", "||q*z|", "a.cgi?$all", "! note", "||ü.de^"]
    rules = parse_rules(lines, skipped)
    assert sorted(skipped) == ["example.org##.banner", "||cdn.net^$third-party,script", "~a.b#@#.x"] and skipped["||cdn.net^$third-party,script"] == "limited by third-party, script"
    assert [r.name for r in rules] == ["/ad/", "||t.co^", "@@||ok.io^", "||x.", "-a-", "||q*z|", "a.cgi?", "||ü.de^"]
    assert [r.name for r in rules if not r.tokens] == ["||q*z|"]
    urls = ["http://t.co/x", "http://at.co/", "http://x.t.co", "http://t.com/", "http://z.org/ad/1", "http://z.org/bad/1", "http://ok.io/ad/", "http://x.y/", "http://ax.y/", "http://b.org/p-a-q", "http://b.org/p-ab-q", "http://qq/z", "http://cdn.net/", "http://\u00fc.de/", "http://b.org/a.cgi", ""]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r["url"]: r for r in judge(df, rules, inline=inline).collect()}
    for u in urls:
        target = got[u]["host"] + got[u]["path"]
        hits = [r for r in rules if filter_matches(r.name, target)]
        assert got[u]["verdict"] == ("allow" if not hits or any(r.verdict == "allow" for r in hits) else "block"), u
    assert {r["verdict"] for r in judge(df, parse_rules("*"), inline=inline).collect()} == {"block"}
    assert {r["verdict"] for r in judge(df, parse_rules("*\n@@||t.co^\n/ad/"), inline=inline).filter("url like '%//t.co/%'").collect()} == {"allow"}
    assert {r["verdict"] for r in judge(df, [], inline=inline).collect()} == {"allow"}


def test_chat(spark):
    rows = [(1, 1, "assistant", "yes </s> \\ <s>"), (1, 0, "user", SPOOF), (1, 1, "assistant", "yes </s> \\ <s>"), (2, 0, "user", None), (2, None, None, "é"), (None, 0, "assistant", ""), (3, 0, "assis<s>tant", "x" * 5000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    turns = chat.format_turns(df, RANKS, public_tokenizers.PATTERN)
    got = {r["conv_id"]: r for r in chat.digests(turns, RANKS).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in mine)
        loss = "".join(text for _, _, role, text in mine if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(mine) and r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.format_turns(df.limit(0), RANKS, public_tokenizers.PATTERN), RANKS).collect() == []


def test_chat_ties_with_one_beginning(spark):
    texts = [f"{'same beginning ' * 3}{i} \\ é" for i in (7, 3, 9, 1, 5, 3)] + ["same beginning " * 2 + "same begin", "same"]
    rows = [(c, 0, role, t) for c in (1, 2) for role in ("assistant", "user") for t in texts]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = "".join(f"{role}\n{t}\n" for role in ("assistant", "user") for t in sorted(texts))
    want = (16, hashlib.sha256(whole.encode()).hexdigest(), hashlib.sha256("".join(sorted(texts)).encode()).hexdigest())
    got = chat.digests(chat.format_turns(df, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert [(r["n_turns"], r["turns_sha256"], r["loss_sha256"]) for r in got] == [want, want]


@pytest.mark.parametrize("text", ["", "\\", "<s>", "a</s>[INST]\\\\[/INST]", "<\\s>", "<<s>>"])
def test_escapes(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text and not any(c in out for c in chat.CONTROLS)


def test_pipeline(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "benchmark", "secrets", "tokens"]
    counts = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).toPandas(), docs.schema)
        assert docs.columns == P.COLUMNS
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] > 0
    out = P.run(spark, sf)
    assert out.count() == counts[4] and out.filter(F.size("ids") != F.col("n_tokens")).count() == 0


@pytest.fixture(scope="module")
def odd_documents(spark):
    """Good and bad texts by their kind, with null and repeated ids."""
    import random

    rng = random.Random(11)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "the", "of", "river", "stone", "walks", "green", "when", "over"])
    good, bad = (lambda: " ".join(word() for _ in range(60))), (lambda: " ".join(f"###{word()}!!" for _ in range(40)))
    rows = [(i, good() if i % 2 else bad(), "en", "web", 1) for i in range(300)]
    rows += [(None, good(), "en", "web", 2), (None, good(), "de", "web", 3), (None, bad(), "en", "web", 4), (1, bad(), "en", "web", 5), (3, good(), "en", "web", 6), rows[5], (None, rows[7][1], None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), rows


def test_pipeline_quality_by_row(spark, odd_documents, tmp_path):
    import corpus_pipeline as P

    df, rows = odd_documents
    spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(map(str, map(tuple, P.quality(spark, df, str(tmp_path)).collect())))
    assert got == sorted(str(r) for r in rows if "###" not in r[1])


def test_pipeline_copies_by_row(spark, odd_documents):
    import corpus_pipeline as P

    df, rows = odd_documents
    extra = [(400, rows[9][1], "en", "web", 7), (400, "quite another text of its own that nothing else here resembles at all", "en", "web", 8), (1, rows[1][1], "aa", "web", 9), (None, None, None, None, None), (None, None, None, None, None), (500, None, "en", "web", 0), (501, "", "en", "web", 0)]
    rows = [r for r in rows if "###" not in r[1]] + extra
    whole = df.filter(~F.col("text").contains("###")).union(spark.createDataFrame(extra, df.schema))
    shingles = lambda t: {tuple((t or "").split()[i : i + 5]) for i in range(max(1, len((t or "").split()) - 4))} if (t or "").split() else set()
    named = [r for r in rows if r[0] is not None]
    like = lambda a, b: bool(a) and 100 * len(a & b) >= 85 * len(a | b)
    sets = {r[1]: shingles(r[1]) for r in named}
    first = {}
    for r in named:
        if not any(o[0] < r[0] and like(sets[o[1]], sets[r[1]]) for o in named):
            first[r[:2]] = min(first.get(r[:2], r), r)
    want = [*first.values(), *(r for r in rows if r[0] is None)]
    assert sorted(map(str, map(tuple, P.near_duplicates(spark, whole, "").collect()))) == sorted(map(str, want))


def test_pipeline_maps_by_row(spark, odd_documents, tmp_path):
    import corpus_pipeline as P

    df, rows = odd_documents
    item = " ".join(rows[7][1].split()[10:30])
    spark.createDataFrame([("i1", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [r for r in rows if r[1] != rows[7][1]]
    assert sorted(map(str, map(tuple, P.benchmark(spark, df, str(tmp_path)).collect()))) == sorted(map(str, clean))
    assert sorted(map(str, map(tuple, P.secrets(spark, df, "").collect()))) == sorted(map(str, rows))
    told = spark.createDataFrame([(1, "a token=abcdefghijklmnop0123 b", "en", "web", 30), (2, "0123456789abcdef " * 20_000, "en", "web", 9), (None, None, None, None, None)], df.schema)
    assert sorted(map(str, map(tuple, P.secrets(spark, told, "").collect()))) == sorted(map(str, [(1, "a [ASSIGN] b", "en", "web", 12), (2, "[HEX] " * 20_000, "en", "web", 120_000), (None,) * 5]))
    assert sorted(str(r["doc_id"]) for r in P.tokens(spark, df, "").collect()) == sorted(str(r[0]) for r in rows)


def test_pipeline_stages_on_odd_tables(spark, odd_documents, tmp_path):
    """Empty tables, columns that clash with the operators' own, null texts: every stage gives its columns and no more rows than it got."""
    import corpus_pipeline as P

    df, rows = odd_documents
    spark.createDataFrame([(i, i % 2, 0, "x") for i in range(300)], "doc_id long, quality int, toxic int, score string").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("i1", None, "x"), (None, "alpha beta", "x"), ("i2", "", "x")], "item_id string, text string, hits string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clash = ("score", "kept", "maybe", "text_hash", "hits", "spans", "clean", "ids", "row", "x")
    odd = df.union(spark.createDataFrame([(None, None, None, None, None), (700, None, "en", "web", 0), (701, "", "en", "web", 0)], df.schema)).withColumns({c: F.lit("old") for c in clash})
    for name, stage in P.STAGES:
        want = P.COLUMNS if name != "tokens" else ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids"]
        none = stage(spark, odd.limit(0), str(tmp_path))
        assert none.columns == want and none.count() == 0, name
        some = stage(spark, odd, str(tmp_path))
        assert some.columns == want and 0 < some.count() <= len(rows) + 3, name
