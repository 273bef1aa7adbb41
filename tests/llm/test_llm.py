"""The training-data operators against brute force, on small tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from agrispark.llm import decontam, html_extract, licenses, maxent, mixing, ngram_join, quality, queries, rindex, secrets, spotsigs
from agrispark.llm.common import connected_components, n_words

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus(spark, texts, **more):
    rows = [(i, t, "en", f"src{i % 3}" if i % 5 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(40000)}" for _ in range(n)]


def near_copies():
    """Texts with exact copies, near copies by edited words, shared passages, one-word, empty and null texts."""
    base = words(150, 1)
    out = [" ".join(base), " ".join(base), None, "", " \t\n", "one", "one", "two words"]
    r = random.Random(5)
    for _ in range(60):
        w = list(base)
        for _ in range(r.randrange(5)):
            w[r.randrange(len(w))] = f"x{r.randrange(9999)}"
        out.append(" ".join(w))
    passage = words(60, 2)
    out += [" ".join(words(90, 10 + k) + passage + words(40, 50 + k)) for k in range(12)]
    out += [" ".join(passage), " ".join([*passage, "more"]), " ".join(words(20000, 9)), " ".join([*words(20000, 9), "tail"])]
    return out


def shingle_sets(texts, k):
    found = []
    for t in texts:
        w = (t or "").encode().lower().split()
        found.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return found


def components(n, links):
    parent = list(range(n))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(a) for a in range(n)]


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, k, num):
    texts = near_copies()
    sets = shingle_sets(texts, k)
    links = [(a, b) for a, b in combinations(range(len(sets)), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    want = components(len(texts), links)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(corpus(spark, texts), k, num, 100).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in range(len(texts))}


def test_near_duplicates_keep_one_of_each_and_all_columns(spark):
    docs = corpus(spark, ["a b c d e f", "a b c d e f", "", None, "g h i j k l"]).withColumn("key", F.lit(1))
    kept = ngram_join.one_of_each(docs.unionByName(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4]


def test_trie_join_equals_sets(monkeypatch):
    r = np.random.default_rng(3)
    base = np.unique(r.integers(1, 300, 120).astype(np.uint64))
    members = [np.unique(np.append(base[r.random(len(base)) < p], r.integers(1, 300, 8).astype(np.uint64))) for p in np.linspace(0.5, 1, 40)]
    queries = members[::3] + [base, base[:5]]

    def similar(q, m):
        return 100 * len(np.intersect1d(q, m)) >= 85 * len(np.union1d(q, m))

    want = {(i, j) for i, q in enumerate(queries) for j, m in enumerate(members) if similar(q, m)}
    assert sorted(ngram_join.trie_join(queries, members, 85, 100)) == sorted(want)
    monkeypatch.setattr(ngram_join, "CELLS", 500)
    assert sorted(ngram_join.trie_join(queries, members, 85, 100)) == sorted(want)
    # under each shingle, the pairs of which it is the first common one
    found = []
    for token in np.unique(np.concatenate(queries)).tolist():
        q = [i for i, x in enumerate(queries) if token in x]
        m = [i for i, x in enumerate(members) if token in x]
        found += [(q[i], m[j]) for i, j in ngram_join.trie_join([queries[i] for i in q], [members[j] for j in m], 85, 100, token)]
    assert sorted(found) == sorted(want)


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(edges, "a", "b").collect()
    assert len(got) == 61 and {r.component for r in got} == {0}


def repeats_brute(texts, length=100):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        cover = [False] * len(b)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                cover[p : p + length] = [True] * length
            seen.add(b[p : p + length])
        kept = bytes(c for c, m in zip(b, cover) if not m)
        spans = sum(m and (i == 0 or not cover[i - 1]) for i, m in enumerate(cover))
        out.append((len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_bytes_equal_brute_force(spark):
    passage = "".join(random.Random(4).choices("abcé ", k=260))
    texts = [t for t in near_copies() if t is None or len(t) < 5000]
    texts += ["x" * 450, "ab" * 300, passage, "start " + passage + " end", passage[40:220] + passage[:150], "é" * 99, "é" * 120, passage[:99]]
    out = rindex.without_repeats(corpus(spark, texts)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert [tuple(r)[1:] for r in sorted(out)] == repeats_brute(texts)


def test_run_length_index():
    index = rindex.RunLengthIndex([b"banana", b"bandana", b"", b"anab"])
    n = len(index.symbols)
    suffixes = sorted(range(n), key=lambda i: index.suffixes.tolist().index(i))
    assert sorted(index.suffixes.tolist()) == list(range(n)) and len(suffixes) == n
    assert index.run_lengths.sum() == n and (index.head_samples == index.suffixes[index.heads]).all()
    places = np.arange(n)
    text = b"banana\0bandana\1\2anab\3"
    want = [i for i in range(n - 2) if not any(c < 4 for c in text[i : i + 3]) and text.find(text[i : i + 3]) < i]
    assert np.flatnonzero(index.repeats(3, places)).tolist() == want


def test_leaks_equal_brute_force(spark):
    items = [" ".join(words(n, 100 + n)) for n in (8, 16, 30, 59)] + ["few words only here", None, ""]
    texts = [f"Lead in, {it.upper()}! tail" for it in items[:4]] + [" ".join(words(200, 7)), None, "", "short"]
    edited = items[3].split()
    edited[2] = "changed"
    half = items[3].split()[:25]
    texts += [" ".join(["pre", *edited, "post"]), " ".join(half), items[2] + " " + items[2]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(corpus(spark, texts), bench).collect()}
    want = set()
    for i, it in enumerate(items):
        w = re.findall(r"[^\W_]+", (it or "").lower())
        bag = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        for d, t in enumerate(texts):
            v = re.findall(r"[^\W_]+", (t or "").lower())
            for s in range(-len(w), len(v)):
                win = v[max(0, s) : max(0, s + len(w))]
                other = Counter(tuple(win[j : j + 5]) for j in range(len(win) - 4))
                if bag and sum((bag & other).values()) >= 0.8 * sum((bag | other).values()):
                    want.add((d, i))
    assert got == want
    kept = decontam.without_leaks(corpus(spark, texts).withColumn("id", F.lit(0)), bench)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(texts))) - {d for d, _ in want})


def test_secrets_base_and_structure():
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abc"
    text = f"API_KEY='abcdef1' token: short secret={'z' * 6} {jwt} AKIA{'A1' * 8} AKIA12 {'0f' * 14} é passwd:ok"
    found = secrets.find_secrets(text)
    kinds = Counter(k for k, _, _ in found)
    assert kinds["assign"] == 2 and kinds["access"] == 1 and kinds["hex"] == 1 and kinds["jwt"] == 1
    assert secrets.find_secrets("") == [] and secrets.confirmed("A" * 40) is None
    der = bytes([0x30, 18, 2, 1, 1, 4, 13]) + b"k" * 13
    assert secrets.is_der_key(der) and not secrets.is_der_key(der[:-1]) and secrets.confirmed(der.hex()) == "der"
    assert secrets.redact_text("x token=abcdefgh y") == "x [assign] y"


def test_secret_base_equals_plain_patterns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(corpus(spark, [None, "", "ToKeN=K" + "K" * 9 + " deadbeef" * 4]).withColumn("doc_id", F.col("doc_id") - 10))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in secrets.scan(docs).collect():
        t = texts[r.doc_id]
        base = [("assign", *m.span()) for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[1]) >= 6]
        base += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert sorted(x for x in map(tuple, r.spans) if x[0] in secrets.BASE_KINDS) == sorted(base)


def test_fingerprints_and_next(spark):
    texts = ["the cat sat on the mat and the dog ran to the park", "", None, "x", "le chat et la souris dans la maison de la ville", "the cat sat on the mat and the dog ran to the park"]
    got = sorted(spotsigs.with_next(corpus(spark, texts), spotsigs._op6_row, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double", "doc_id", "text", 2).collect())
    plain = [t or "" for t in texts]
    for r, t, after in zip(got, plain, plain[1:] + plain[:1], strict=True):
        new = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and r.n_chars == len(t)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[0].fingerprint == got[5].fingerprint and got[5].near_next == 1.0 and got[1].fingerprint == ""


def test_spot_pairs_equal_brute_force(spark):
    texts = [t for t in near_copies() if t is None or len(t) < 5000] + ["the a b of c d to e f and g h", "the a b of c d to e f and g h in i j"]
    got = {tuple(sorted(r[:2])) for r in spotsigs.near_pairs(corpus(spark, texts), 0.6).collect()}
    sets = {spotsigs.as_text(s): s for t in texts if (s := spotsigs.signatures(t or ""))}
    want = {tuple(sorted(p)) for p in combinations(sets, 2) if spotsigs.likeness(sets[p[0]], sets[p[1]]) >= 0.6}
    assert got == want and want


def test_mix_equals_its_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(corpus(spark, [None, "", "a b"]))
    docs = docs.unionByName(docs.limit(20))
    a, b = (sorted(map(tuple, mixing.mix(docs, shard_words=500).collect()), key=str) for _ in range(2))
    assert a == b and all(0 <= r[5] <= 2 * r[2] for r in a)
    for source in {r[1] for r in a}:
        own = [r for r in a if r[1] == source]
        assert abs(sum(r[5] for r in own) - own[0][4]) <= 64 + 0.02 * own[0][4] + 32 * math.ceil(own[0][3] / 500)


def test_seats_by_highest_quotients(spark):
    cells = spark.createDataFrame([("g", k, float(w), 57) for k, w in enumerate([5, 100, 33.3, 33.3, 0, 1])], "g string, k bigint, w double, seats bigint")
    got = {r.k: r.quota for r in mixing.sainte_lague(cells, ["g"], "k", "w", "seats").collect()}
    w, seats = [5, 100, 33.3, 33.3, 0, 1], [0] * 6
    for _ in range(57):
        best = max(range(6), key=lambda i: (w[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    assert got == dict(enumerate(seats))


def test_word_counts(spark):
    texts = [None, "", " ", "a", " a\tb\x0bc ", "a b", "x\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", n_words(F.col("t")).alias("n"))
    assert {r.i: r.n for r in df.collect()} == {i: len((t or "").encode().split()) for i, t in enumerate(texts)}


def test_language_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(corpus(spark, [None, ""]).withColumn("doc_id", F.col("doc_id") - 5))
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b"\n"] for r in docs.collect()}
    train = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(train.values()), len(train)
    got = maxent.scored(docs).collect()
    for r in got:
        t = texts[r.doc_id]
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in train for w in t), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    split = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    out = quality.classified(docs, labels.where(~split), F.col("source"), F.col("lang")).withColumnRenamed("_id", "doc_id")
    r = out.join(labels.where(split).withColumnsRenamed({"quality": "q", "toxic": "t"}), "doc_id").select(
        F.avg(((F.col("quality") >= 0.5).cast("int") == F.col("q")).cast("int")).alias("q"), F.avg(((F.col("toxic") >= 0.5).cast("int") == F.col("t")).cast("int")).alias("t")
    ).first()
    assert r.q > 0.9 and r.t > 0.85


def test_quality_without_labels_and_with_nulls(spark):
    docs = corpus(spark, [None, "", "plain text here"]).withColumn("host", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.classified(docs, none, F.col("source"), F.col("lang")).count() == 3
    assert quality.keep_good(docs, none).columns == docs.columns


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>var t="<p>no</p>";</script></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="ad">Buy now.</div>%s<div class="comments">Great post.</div><footer>&copy; site</footer></body></html>"""


def test_html_main_text(spark):
    article = "<article><h1>A  title &amp; more</h1><p><b>One two, three.<br>four<p>Five &lt;six&gt; seven, eight.</p><aside class=sidebar>Related</aside></article>"
    rows = [(k, "u", PAGE % article) for k in range(30)] + [(90, "u", None), (91, "u", ""), (92, "u", "<p>unclosed"), (93, "u", "no tags at all")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extracted(pages, html_extract.trained(pages)).collect()}
    assert got[3] == "A title & more\n\nOne two, three. four\n\nFive <six> seven, eight."
    assert got[90] == got[91] == ""


def test_marginals_equal_enumeration():
    page = html_extract.parse("<body><div class=ad>x<p>a, b.</p></div><article><p>Long text, here.</p></article></body>")
    pot = html_extract.Potentials(Counter({("tag p", 1): 9, ("tag p", 0): 2, ("tag article", 1): 5}))
    n = len(page.parent)
    unary = [[sum(pot.table.get(x, (0, 0))[y] for x in names) for y in (0, 1)] for names in html_extract.features(page)]
    unary[0][1] -= 20
    mass = np.zeros((n, 2))
    where = html_extract.regions(page)
    for code in range(2**n):
        y = [code >> v & 1 for v in range(n)]
        p = math.exp(sum(unary[v][y[v]] for v in range(n)) + sum(pot.edge[where[v]][y[page.parent[v]]][y[v]] for v in range(1, n)))
        for v in range(n):
            mass[v, y[v]] += p
    assert np.allclose(html_extract.marginals(page, pot), mass[:, 1] / mass.sum(axis=1))


def test_license_scan_and_inheritance(spark):
    mit = licenses.TEMPLATES["MIT"]
    rows = [("a/LICENSE", mit), ("a/b/x.py", "code only"), ("a/b/LICENSE", licenses.TEMPLATES["Apache-2.0"]), ("a/b/c/y.py", None), ("z/q.py", "nothing"), ("z/r.py", "some words\nReleased under the MIT License.\nmore words")]
    got = {r.path: (r.license, r.inherited_from) for r in licenses.scanned(spark.createDataFrame(rows, "path string, text string"), "path", F.col("path")).collect()}
    assert got["a/b/x.py"] == ("Apache-2.0", "a/b") and got["a/b/c/y.py"] == ("Apache-2.0", "a/b")
    assert got["z/q.py"] == (None, None) and got["z/r.py"] == ("MIT", None) and got["a/LICENSE"][0] == "MIT"


@pytest.mark.parametrize("name", ["op2_decontaminate", "op3_suffix_dedup", "op4_quality_classifier", "op5_ngram_join", "op6_spotsigs", "op7_license_scan", "op8_secret_scan", "op9_lm_score", "op10_mix_sources"])
def test_empty_tables(spark, name, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_pipeline_keeps_columns_and_clean_documents(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert 0 < len(out) <= len(ids) and {r.doc_id for r in out} <= ids


def test_mix_sql(spark):
    import duckdb

    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(c.sql(queries.ORACLE_SQL["op10_mix_sources"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op10_mix_sources"](spark, SF).collect())) == want
