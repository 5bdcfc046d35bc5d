"""Operators on conversations, URLs and vectors, and the registered queries."""

import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orestrata.llm import chat, neighbours, queries, urls

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in queries.SCHEMAS:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = queries.queries()[name](spark, SF_DIR)
    cursor = connection.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(cursor.fetchall(), key=str)


def test_escaping_is_reversible(spark):
    random.seed(1)
    bits = ["<", "[", "\\", "|im_end|>", "/s>", "s>", "INST]", "/INST]", "<|im_sep|>", "[/INST]", "<<SYS>>", "x", "\n", "<|image|>", "é"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 9))) for _ in range(400)]
    rows = spark.createDataFrame([(i, 0, t, t) for i, t in enumerate(texts)], "conv_id bigint, turn bigint, role string, text string")
    chats = chat.format_chats(rows.withColumn("parts", chat.text_parts(F.col("text"))))
    for r in chats.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), "formatted").collect():
        assert [(t.role, t.text) for t in r.turns] == [(texts[r.conv_id], texts[r.conv_id])]
        assert r.formatted.count("<|im_end|>") == 1 and "</s>" not in r.formatted and "[/INST]" not in r.formatted


def test_parts_and_nulls(spark):
    rows = spark.createDataFrame(
        [
            (1, 1, "assistant", [("text", "</", None, None), ("text", "s> two words", None, None)]),
            (1, 0, "user", [("image", None, "a.png", None), ("text", "see", None, None), ("document", None, "d.pdf", 7)]),
            (1, None, None, None),
            (None, 0, "assistant", [("text", None, None, None)]),
        ],
        f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}",
    ).withColumn("place", F.lit(9))
    got = {r.conv_id: r for r in chat.format_chats(rows).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert got[1].formatted.startswith("<|im_start|>user<|im_sep|><|image|>see<|document|><|im_end|><|im_start|>assistant<|im_sep|><\\/s>")
    assert [(a.turn_place, a.type, a.ref, a.tokens) for a in got[1].attachments] == [(1, "image", "a.png", 256), (1, "document", "d.pdf", 7)]
    assert got[1].loss == "</s> two words" and got[1].expanded_tokens == 256 + 7 + 1 + 1 + 3
    assert got[None].loss == "" and chat.format_chats(rows.limit(0)).count() == 0


def test_urls(spark):
    found = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://A.Example.ORG/en/123": ("a.example.org", "/en/123", "example.org/en/1", "block"),
        "http://xexample.org/en/1": ("xexample.org", "/en/1", "org/", "allow"),
        "http://org": ("org", "", None, "allow"),
        "x://a.com/de/?q=/fr/": ("a.com", "/de/", "com/de/", "block"),
        "x://a.net/malware/x": ("a.net", "/malware/x", None, "block"),
        "x://a.net/Malware/x": ("a.net", "/Malware/x", None, "block"),
        "x://a.net/malwares": ("a.net", "/malwares", None, "allow"),
        "x://ads.a.net/x": ("ads.a.net", "/x", None, "block"),
        "x://a.net/x/Ads/y.js": ("a.net", "/x/Ads/y.js", None, "block"),
        "x://a.net/ads": ("a.net", "/ads", None, "allow"),
    }
    pages = spark.createDataFrame([(i % 7, u, "h") for i, u in enumerate([*found] * 2)], "page_id bigint, url string, place string")
    got = urls.judge_urls(pages, queries.URL_RULES).collect()
    assert sorted(map(str, [(r.host, r.path, r.rule, r.verdict) for r in got])) == sorted(map(str, [*found.values()] * 2))
    assert urls.judge_urls(pages, []).filter("verdict = 'allow'").count() == 2 * len(found)
    assert urls.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_words_of_patterns(spark):
    words = {
        r"^(?:[^/]*\.)?example\.org/en/1": {"example", "org", "en"},
        r"(?i)(?:^|[^A-Za-z0-9])Big\-Win(?:$|[^A-Za-z0-9])": {"big", "win"},
        r"(?is)^.*/ads/.*\.js$": {"ads", "js"},
        r"/ab+c/de?/f.g/h*/ij/\bkl\b[/.]mn[a-z]+/": {"ij", "kl"},
        r"/one/two|/three/": set(), r"/(?:one|two)/three/": {"three"}, r"(/a/(/b/)?)+/c/": {"c"}, r"/x{2}/[^a]/y[&/]z/": set(),
        r"\Q/a/\E": set(), r"(?x)/a b/": set(), r"/a(?i)/b/": {"b"}, r"/[]a]/b/": set(), r"\\pXfoo/": set(), r"/\x61b/": set(), "": set(),
        r"/a\.?b/c\d/d(?!x)/e/": {"e"}, r"/é1é/(?:/|$)?a/": {"1"}, "a": set(), "^a$": {"a"}, r"/p\/q_r%s-": {"p", "q", "r", "s"},
    }
    rows = spark.createDataFrame([(p,) for p in words], "pattern string").repartition(2)
    got = {r.pattern: set(r.words) for r in rows.select("pattern", urls.literal_words(F.col("pattern")).alias("words")).collect()}
    for pattern in words:
        assert got[pattern] <= words[pattern] or pattern == "", (pattern, got[pattern])
    exact = [p for p in words if p not in (r"/x{2}/[^a]/y[&/]z/", r"/[]a]/b/")]
    assert {p: got[p] for p in exact} == {p: words[p] for p in exact}


def test_ten_thousand_rules(spark):
    """The same verdicts as by running every rule on every URL, for a few runs a URL."""
    pick = random.Random(8)
    names = ["".join(pick.choices("abcdeXY", k=pick.randint(2, 3))) for _ in range(400)]
    name = lambda: pick.choice(names)
    rules = []
    for i in range(10_000):
        rules.append(
            pick.choice(
                [
                    lambda: urls.place_rule(pick.choice(["allow", "block"]), f"{name()}.{name()}.org".lower(), f"/{name()}"),
                    lambda: urls.text_rule("block", f"{name()}-{name()}-{name()}"),
                    lambda: urls.glob_rule("block", f"*.{name()}.*/{name()}/*"),
                    lambda: urls.Rule(f"r{i}", "block", rf"/{name()}(?:{name()}|{name()})?/{name()}[0-9]+/.*\.{name()}$", 0, False),
                ]
            )()
        )
    places = [f"{name()}.{name()}.org/{name()}/{name()}{pick.choice(['', '/', '-' + name()])}{pick.randint(0, 9)}/x.{name()}" for _ in range(300)]
    for rule in pick.sample([r for r in rules if r.level == 1], 60):
        places.append(f"www.{rule.name}x/y")
    schema = "number int, name string, verdict string, pattern string, level int, named boolean"
    table = spark.createDataFrame([(i, r.name, r.verdict, r.pattern, r.level, r.named) for i, r in enumerate(rules)], schema)
    pages = spark.createDataFrame([(i, "x://" + p) for i, p in enumerate(places)], "page_id bigint, url string")
    got = {r.page_id: r for r in urls.judge_urls(pages, table).collect()}
    compiled = [re.compile(r.pattern) for r in rules]
    hits = 0
    for i, place in enumerate(places):
        host, slash, path = place.partition("/")
        text = host.lower() + slash + path
        fit = [r for r, c in zip(rules, compiled, strict=True) if c.search(text)]
        hits += len(fit)
        first = min(fit, key=lambda r: (-r.level, -len(r.name), r.name, r.verdict), default=None)
        assert got[i].verdict == (first.verdict if first else "allow")
        assert got[i].rule == (first.name if first and first.named else None)
    runs = urls.candidates(pages.select(F.concat(urls.host_of(F.col("url")), urls.path_of(F.col("url"))).alias("place")), table).count()
    assert 60 <= hits <= runs < 0.02 * len(rules) * len(places)


def test_neighbours(spark):
    random = np.random.default_rng(0)
    vectors = random.normal(size=(1500, 16))
    vectors[700:1100] = vectors[700]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0] * 15 + [float("inf")], [1.0, None] * 8, [1.0] * 3]
    rows += [(2000 + 50 * i, v) for i, v in enumerate(odd)] + [(None, [1.0] * 16), rows[5]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, rank int")
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0, settings=neighbours.Settings(sample=800, search=300, block=100)).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        scores = unit @ unit[q]
        scores[q] = -9
        best = np.lexsort((np.arange(1500), -np.round(scores, 12)))[:5]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert all(r.score == pytest.approx(scores[r.vec_id]) for r in own)
        hits += len({r.vec_id for r in own} & set(best.tolist()))
    assert len(got) == 150 and hits >= 0.9 * 150
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(df.filter("vec_id < 3"), F.lit(True)).count() == 6


def test_neighbours_of_repeated_rows(spark):
    """Ten copies of a query, of a near row, and of one of several equal vectors, and a key with
    ten vectors: repeated keys take one place each."""
    near = [(i, [1.0, 0.01 * i, 0.0]) for i in range(7)]
    equal = [(i, [0.0, 1.0, 0.5]) for i in range(7, 16)]
    rows = [*near, *equal] + [near[0], near[1], equal[0]] * 9 + [(30, [0.001 * i, 0.001, 1.0]) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id").isin(0, 15, 30)).collect()
    found = {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 15, 30)}
    assert found[0] == [1, 2, 3, 4, 5] and found[15] == [7, 8, 9, 10, 11]
    assert found[30] == [7, 8, 9, 10, 11]


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").toPandas()
    unit = np.array(rows.embedding.tolist(), float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect()
    want = set()
    for at in np.flatnonzero(rows.vec_id % 50 == 0):
        scores = unit @ unit[at]
        scores[at] = -9
        want |= {(rows.vec_id[at], rows.vec_id[i]) for i in np.argsort(-scores)[:5]}
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)


def test_recall_where_the_forest_prunes(spark):
    """Vectors in clusters: nine in ten neighbours are found by looking at a tenth of the rows."""
    random = np.random.default_rng(5)
    middles = random.normal(size=(800, 32))
    vectors = (middles[random.integers(800, size=50_000)] + 0.5 * random.normal(size=(50_000, 32))).astype(np.float32)
    unit = vectors.astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    df = spark.createDataFrame(
        pd.DataFrame({"vec_id": range(len(vectors)), "embedding": vectors.tolist()}), "vec_id bigint, embedding array<float>"
    )
    settings = neighbours.Settings(trees=8, search=5_000, share=0.1)
    got = neighbours.nearest(df, F.col("vec_id") % 250 == 0, settings=settings).collect()
    want = set()
    for at in range(0, len(unit), 250):
        scores = unit @ unit[at]
        scores[at] = -9
        want |= {(at, int(i)) for i in np.argpartition(-scores, 5)[:5]}
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)


def test_queries_look_at_as_much_as_they_are_told():
    random = np.random.default_rng(6)
    vectors = random.normal(size=(4000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    forest = [neighbours.grow(vectors, neighbours.Settings(), random) for _ in range(4)]
    filed = [neighbours.leaf_of(tree, vectors) for tree in forest]
    sizes = [{int(leaf): int((leaves == leaf).sum()) for leaf in set(leaves.tolist())} for leaves in filed]
    assert max(max(tree.values()) for tree in sizes) <= neighbours.Settings().leaf
    for at in range(0, 4000, 400):
        opened = list(neighbours.open_leaves(forest, sizes, vectors[at], 400))
        assert len(set(opened)) == len(opened) and 400 <= sum(sizes[t][leaf] for t, leaf in opened) < 400 + neighbours.Settings().leaf
        # First of all its own leaf of each tree.
        assert set(opened[:4]) == {(t, int(leaves[at])) for t, leaves in enumerate(filed)}


def test_pipeline(spark):
    """Each stage works on what the one before it kept."""
    docs = queries.table(spark, SF_DIR, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "pii", "mixing", "sentencepiece"]
    start = docs.filter("doc_id < 60")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        after = stage(spark, start, SF_DIR)
        assert after.columns == docs.columns
        start = spark.createDataFrame(after.collect(), docs.schema)
    last = corpus_pipeline.encode_pieces(spark, start, SF_DIR)
    assert last.count() == start.count() and last.filter("n_tokens <> size(token_ids)").isEmpty()


def test_near_copies_are_dropped_by_text(spark):
    """A repeated doc_id loses the text that is a near copy, not its other text."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "more"])), (2, "a clean text of its own that nothing else is like"), (2, None), (None, "one")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(str(r) for r in docs.select("doc_id", "text").collect() if r.text != rows[1][1])
