"""The manifest, the BPE codec and the source audit against plain versions, and on edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tickloom.llm import bpe_transducer, queries
from tickloom.llm.common import ascii_lower, fold
from tickloom.llm.divergence_audit import _counts_of, count_terms, source_audit
from tickloom.llm.merkle_manifest import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EDGES = [
    (1, None, None, None, None), (2, "", "", "", 0), (3, "Aé:1-", "en", "-", 5), (4, "tie", "en", "s", 3),
    (4, "TIE", "en", "s", 3), (5, "same ROW", "en", "s", 8), (5, "same ROW", "en", "s", 8),
    (None, "no id", "de", "s", 5), (None, None, "de", "s", None), (6, "Long text " * 20_000, "de", "s", 1),
    ((1 << 53) + 1, "Grüße мир 中文 \x00\x1c\x85  <|endoftext|>", "de", "t", 2), (7, "\U0001f600՘\U00010940a", "de", "", 3),
    *[(100 + i, f"Common word{i % 7} words of row {i}", "en", f"s{i % 3}", i) for i in range(60)],
]


def clashing(df):
    """The table with a column for every name the three operators use inside."""
    names = (
        "tree leaf changed rank total block at node level left right part row first base up n docs term "
        "ids well_formed v m value p q a b lang_n lang_total place before in_sources seen proof root"
    )
    for name in names.split():
        df = df.withColumn(name, F.lit("other"))
    return df


@pytest.fixture(scope="module")
def edges(spark):
    return clashing(spark.createDataFrame(EDGES, SCHEMA).repartition(3))


@pytest.fixture(scope="module")
def empty(spark):
    return clashing(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="module", params=["table", "edges"])
def docs(request, spark, small_dir, edges):
    return edges if request.param == "edges" else spark.read.parquet(f"{small_dir}/documents.parquet")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(r, text):
    fields = (r.doc_id, r.source, r.lang, r.n_chars, text)
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def plain_tree(nodes):
    """All levels of a tree, and for each leaf the siblings on the way up, as (left, right) lists."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    steps = []
    for i in range(len(nodes)):
        way = []
        for level in levels[:-1]:
            first = i // 16 * 16
            way.append((level[first:i], level[i + 1 : first + 16]))
            i //= 16
        steps.append(way)
    return levels[-1][0], steps


def plain_manifest(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r.source].append((r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.text), r))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    inside = {s: plain_tree([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in order}
    root, above = plain_tree([inside[s][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for (_, _, leaf, r), steps in zip(sorted(trees[s], key=lambda x: x[:3]), inside[s][1], strict=True):
            way = steps + above[place]
            crc = zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode())
            cur = leaf
            if crc % 5 == 0 and r.text is not None:
                cur = plain_leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text))
            for left, right in way:
                cur = sha("".join([*left, cur, *right]))
            proof = sha("".join(x for step in way for side in step for x in side))
            out.append((r.doc_id, leaf, inside[s][0], root, proof, cur, cur == root))
    return sorted(out, key=repr)


NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def audited(df, **options):
    return manifest(df, altered=ascii_lower(F.col("text")), where=fold("doc_id", 5) == 0, **options)


@pytest.mark.parametrize("height", [1, 2])
def test_manifest(docs, height):
    got = sorted((tuple(r) for r in audited(docs, height=height).select(*NAMES).collect()), key=repr)
    names = ("doc_id", "source", "lang", "n_chars", "text")
    assert got == plain_manifest(docs.select(*names).collect())


def test_manifest_over_three_exchanges(spark):
    """One source of 5,000 leaves in superblocks of 16, beside 40 small ones."""
    rows = [(i, f"Text {i}", "en", "hot", i) for i in range(5_000)]
    rows += [(10_000 + i, f"Text {i}", "en", f"s{i % 40}", i) for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in audited(docs, height=1).select(*NAMES).collect()), key=repr)
    assert got == plain_manifest(docs.collect())


def test_proofs_fold_by_themselves(edges):
    for r in manifest(edges, with_proofs=True).collect():
        cur = r.leaf
        for left, right in r.proof:
            cur = sha(left + cur + right)
        assert cur == r.root and r.verified
        assert r.proof_sha256 == sha("".join(left + right for left, right in r.proof))


def test_one_document_is_its_own_root(spark):
    one = spark.createDataFrame([(5, "x", None, None, None)], SCHEMA)
    r = manifest(one).first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == sha("")


RANKS = bpe_transducer.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def tiktoken_encode():
    made = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
    )
    return made.encode_ordinary


def test_codec_on_tables(docs, tiktoken_encode):
    encoded = bpe_transducer.encode_texts(docs)
    got = sorted(map(tuple, bpe_transducer.digest(bpe_transducer.decode_ids(encoded)).collect()), key=repr)
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = tiktoken_encode(r.text or "")
        packed = np.array(ids, "<u4").tobytes()
        want.append((r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), sha(r.text or "")))
    assert got == sorted(want, key=repr)
    both = sorted(map(tuple, bpe_transducer.digest(bpe_transducer.round_trip(docs)).collect()), key=repr)
    assert both == got


def any_text(rng):
    n = rng.randrange(1, 200)
    ranges = [(0x20, 0x250), (0x370, 0x2100), (0xE000, 0x110000), (0x10900, 0x13000), (0x9, 0x20)]
    return rng.choice([
        lambda: "".join(rng.choices("the ing tion ann 0123 \n\t'sll", k=n)),
        lambda: "".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(n)),
        lambda: "a" * n + "ha" * n + "=" * n + " " * n,
    ])()


def test_transducer_is_merging(tiktoken_encode):
    """Also with a table of states so small that it begins anew all the time."""
    rng = random.Random(5)
    whole = bpe_transducer.codec("byte_bpe_multi_50k.tiktoken")
    tight = bpe_transducer.Codec(RANKS, public_tokenizers.PATTERN)
    tight._pieces._transducer._max_states, tight._pieces._kept = 20, 5
    for _ in range(1_500):
        text = any_text(rng)
        want = np.array(tiktoken_encode(text), "<u4").tobytes()
        assert whole.encode(text) == tight.encode(text) == want
        assert whole.decode(want) == (text, True)


def test_transducer_of_any_vocabulary():
    """Ranks in no sensible order, tokens that merging never makes, and blocks of a few bytes."""
    rng = random.Random(6)
    for _ in range(60):
        words = {bytes(rng.choices(b"abc", k=rng.randrange(2, 6))) for _ in range(25)}
        order = [*(bytes([b]) for b in b"abc"), *rng.sample(sorted(words), len(words))]
        ranks = {w: i for i, w in enumerate(order)}
        made = bpe_transducer.Transducer(ranks)
        for _ in range(60):
            data = bytes(rng.choices(b"abc", k=rng.randrange(1, 60)))
            assert made.run(data) == bpe_transducer.merged(data, ranks)


def test_transducer_emits_while_it_reads(monkeypatch, tiktoken_encode):
    monkeypatch.setattr(bpe_transducer, "_BLOCK", 7)
    made = bpe_transducer.Transducer(RANKS)
    for word in ("internationalization" * 9, "a" * 500, "ħéłłø" * 40):
        assert made.run(word.encode()) == bpe_transducer.merged(word.encode(), RANKS)


def test_long_runs_take_linear_time():
    made = bpe_transducer.Transducer(RANKS)
    steps = 0
    after = made.after

    def counted(state, b):
        nonlocal steps
        steps += 1
        return after(state, b)

    made.after = counted
    assert b"".join(made._bytes[i] for i in made.run(b"ab" * 500_000)) == b"ab" * 500_000
    assert steps < 200


def test_streaming_decoder_is_the_utf8_decoder():
    rng = random.Random(7)
    made = bpe_transducer.codec("byte_bpe_multi_50k.tiktoken")
    for _ in range(2_000):
        ids = [rng.choice([rng.randrange(256), rng.randrange(50_256)]) for _ in range(rng.randrange(1, 30))]
        data = b"".join(made._bytes[i] for i in ids)
        decoder = made.decoder()
        text = "".join(decoder.feed(ids[i : i + 2]) for i in range(0, len(ids), 2)) + decoder.finish()
        assert text == data.decode("utf-8", "replace")
        assert decoder.well_formed == (data.decode("utf-8", "ignore").encode() == data)


def test_ids_beyond_the_vocabulary(spark):
    ids = np.array([60_000, RANKS[b"a"]], "<u4").tobytes()
    df = spark.createDataFrame([(1, bytearray(ids)), (2, None)], "doc_id long, ids binary")
    out = {r.doc_id: (r.text, r.well_formed) for r in bpe_transducer.decode_ids(df).collect()}
    assert out == {1: ("�a", False), 2: ("", True)}


def plain_terms(text):
    kept = "".join(
        c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or ord(c) > 127 else " " for c in text or ""
    )
    return [t for t in kept.split(" ") if t]


def plain_audit(rows, min_docs=10, ranks=10):
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        lang, terms = r.lang or "", plain_terms(r.text)
        counts[lang, r.source or ""].update(terms)
        in_docs[lang].update(set(terms))
    out = []
    for lang in {lang for lang, _ in counts}:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        groups[None] = sum(groups.values(), Counter())
        share = {}
        for s, c in groups.items():
            total = sum(c[t] for t in kept)
            share[s] = {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in groups:
            if s is None:
                continue
            pairs = [
                (-sum(f(share[s][t], share[x][t]) for t in kept), x.encode()) for x in groups if x not in (s, None)
            ]
            terms = [
                (-f(share[s][t], share[None][t]), t.encode())
                for t in kept
                if groups[s][t] and share[s][t] > share[None][t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out += [(lang, s, part, x.decode(), -v, i) for i, (v, x) in enumerate(found, 1)]
    return sorted(out)


def test_audit(docs):
    got = sorted(map(tuple, source_audit(docs).collect()))
    assert got == plain_audit(docs.select("lang", "source", "text").collect())


def test_audit_of_ties_that_cross_the_last_rank(spark):
    """Many terms of equal counts, a source without terms, and counts handed on early."""
    rng = random.Random(8)
    vocabulary = [f"{a}{b}é" for a in "abcdefgh" for b in "abcdefgh"]
    rows = [(i, " ".join(rng.sample(vocabulary, 30)), "en", f"s{i % 4}", 0) for i in range(80)]
    rows += [(i, " ".join(vocabulary[:12]), "en", "s0", 0) for i in range(80, 90)]
    rows += [(90, "123 456", "en", "none", 0), (91, None, "xx", "a", 0), (92, "", "xx", "b", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = plain_audit(docs.collect())
    assert sorted(map(tuple, source_audit(docs).collect())) == want
    early = count_terms(docs, held=5).groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs"))
    late = count_terms(docs).groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs"))
    assert sorted(map(tuple, early.collect()), key=repr) == sorted(map(tuple, late.collect()), key=repr)


def test_counts_of_documents_taken_together():
    """Terms of several groups and documents, a document's repeats and groups out of order."""
    rng = random.Random(4)
    documents = [(rng.randrange(3), [rng.choice(b"a bb \xc3\xa9 d".split()) for _ in range(rng.randint(1, 9))]) for _ in range(50)]
    tokens = [t for _, terms in documents for t in terms]
    terms, numbers = _counts_of(tokens, [len(terms) for _, terms in documents], [g for g, _ in documents])
    want = []
    for group, term in {(g, t) for g, terms in documents for t in terms}:
        found = [terms.count(term) for g, terms in documents if g == group and term in terms]
        want.append((term, group, sum(found), len(found)))
    assert sorted(zip(terms.to_pylist(), *(x.tolist() for x in numbers), strict=True)) == sorted(want)


def test_a_text_of_several_slices_is_one_document(spark):
    long = "Again and é " * 400_000
    rows = [(1, long, "en", "s", 0), (2, "and again", "en", "s", 0), (3, long, "en", "t", 0), (4, None, None, "t", 0)]
    counted = count_terms(spark.createDataFrame(rows, SCHEMA)).groupBy("lang", "source", "term")
    got = {tuple(r) for r in counted.agg(F.sum("n"), F.sum("docs")).collect()}
    want = {("en", "s", b"again", 400_001, 2), ("en", "s", b"and", 400_001, 2), ("en", "s", "é".encode(), 400_000, 1)}
    want |= {("en", "t", x.encode(), 400_000, 1) for x in ("again", "and", "é")}
    assert got == want | {("en", "s", None, 0, 0), ("en", "t", None, 0, 0), ("", "t", None, 0, 0)}


@pytest.mark.parametrize("run", [
    manifest, audited, bpe_transducer.encode_texts, bpe_transducer.round_trip, source_audit,
    lambda d: bpe_transducer.digest(bpe_transducer.decode_ids(bpe_transducer.encode_texts(d))),
])
def test_empty_table(empty, run):
    assert run(empty).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_agrees(spark, small_dir, name):
    spark_rows = queries.QUERIES[name](spark, small_dir)
    columns = ", ".join(spark_rows.columns)
    with duckdb.connect() as db:
        for table in ("documents", "benchmark", "pages"):
            db.sql(f"CREATE VIEW {table} AS FROM '{small_dir}/{table}.parquet'")
        want = db.sql(f"SELECT {columns} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, spark_rows.collect()), key=repr) == sorted(want, key=repr)
