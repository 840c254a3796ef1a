"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import itertools

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starlode.llm.components import components
from starlode.llm.decontamination import contamination, is_contaminated, without_contaminated
from starlode.llm.language import fit, identify
from starlode.llm.lines import line_dedup
from starlode.llm.merkle import digest, folded, manifest, siblings
from starlode.llm.mixing import mix, n_words
from starlode.llm.quality import RULES, Rule, keep_good, quality
from starlode.llm.secret_scan import scan, trigram_query
from starlode.llm.simhash import near_documents, one_per_group, stars
from starlode.llm.substrings import substring_dedup
from starlode.llm.suffixes import common_prefixes, intervals, maximal_repeats, suffix_array, suffix_dedup
from starlode.llm.tokens import Frequent, Lookup, frequent, read_definition, token_counts
from starlode.llm.warc import archive
from starlode.llm.whitening import cross_products, whiten
from tests.llm import brute

SHARED = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
LONG = " ".join(f"w{i}" for i in range(20_000)) + "\n" + "ab" * 30_000
CLASHES = "n_words int, size string, chunk string, bucket int, row_key int, digest string, quality int"
CLASHES += ", spans int, fingerprint string, component_id int, words string, word int, known int, key int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
TEXTS = [
    (None, None, None),
    (None, SHARED, "b"),
    (1, "", "a"),
    (1, "", "a"),
    (2, None, None),
    (3, f"start {SHARED}\nmid\n\nend", "a"),
    (4, f"{SHARED} other words", "b"),
    (4, f"{SHARED} other words", "b"),
    (4, "another text of the same id", "b"),
    (5, LONG, "a"),
    (6, LONG + "x", "c"),
    (7, "é ü ñ 漢字 😀 \x0b tab\tend", "c"),
    (8, " \n \t ", "c"),
]


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(i, t, "en", s, 0, *[None] * 14) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, SHARED), (2, SHARED), (None, SHARED), (3, None), (4, ""), (5, "another text")]
    return spark.createDataFrame(rows, "item_id long, text string")


VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

OPERATORS = {
    "contamination": lambda d, items: contamination(d, items),
    "mix": lambda d, items: mix(d, n_words(F.col("text"))),
    "suffix": lambda d, items: suffix_dedup(d),
    "repeats": lambda d, items: maximal_repeats(d),
    "quality": lambda d, items: quality(d, out="judged"),
    "keep_good": lambda d, items: keep_good(d),
    "simhash": lambda d, items: near_documents(d),
    "one_per_group": lambda d, items: one_per_group(d),
    "scan": lambda d, items: scan(d),
    "substring": lambda d, items: substring_dedup(d),
    "language": lambda d, items: identify(d, fit(d)),
    "lines": lambda d, items: line_dedup(d, n_lines="lines_in", n_removed="lines_out"),
    "tokens": lambda d, items: token_counts(d, VOCABULARY),
    "merkle": lambda d, items: manifest(d.withColumn("leaf", digest(F.col("text"))), "lang", "doc_id", "leaf"),
    "clean": lambda d, items: without_contaminated(d, items),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(spark, messy, items, name):
    assert OPERATORS[name](messy.limit(0), items.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"contamination", "keep_good", "one_per_group", "clean", "repeats"}))
def test_one_row_per_row(messy, items, name):
    assert OPERATORS[name](messy, items).count() == len(TEXTS)


@pytest.mark.parametrize("name", ["keep_good", "one_per_group", "lines", "clean"])
def test_columns_stay(messy, items, name):
    assert set(messy.columns) <= set(OPERATORS[name](messy, items).columns)


def test_stages_return_documents(spark, messy, tmp_path, items):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    for docs, (name, stage) in itertools.product((messy, messy.limit(0)), corpus_pipeline.STAGES):
        found = stage(spark, docs, str(tmp_path))
        found.collect()
        assert name == "mixing" or found.columns == messy.columns


def test_contamination_of_odd_rows(messy, items):
    rows = {(r.doc_id, r.digest): r for r in contamination(messy, items).withColumn("bad", is_contaminated()).collect()}
    assert len(rows) == 11  # two pairs of rows are equal in id and text
    of = {}
    for (i, _), r in rows.items():
        of.setdefault(i, []).append((r.n_words, r.n_hit, r.n_items, r.bad))
    assert of[3] == [(19, 16, 2, True)]
    assert sorted(of[4]) == [(6, 2, 1, True), (18, 16, 2, True)]
    assert of[1] == [(0, 0, 0, False)] and of[2] == [(0, 0, 0, False)]
    assert sorted(of[None]) == [(0, 0, 0, False), (16, 16, 2, True)]


def test_many_prefixes_are_joined(spark, messy, items, monkeypatch):
    from starlode.llm import decontamination

    both = messy.unionByName(messy)
    rows = lambda: sorted(map(str, contamination(both, items).collect()))
    few = rows()
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    assert rows() == few and len(few) == 11
    assert contamination(messy.limit(0), items).isEmpty()


def test_texts_are_cut_once_per_pass(spark, messy):
    """No filter below the explosion of the words cuts every text a second time."""
    from starlode.llm.decontamination import _word_stream, words_of

    worded = messy.select("doc_id", F.lit(1).alias("digest"), F.concat(words_of(F.col("text")), F.array(F.lit(""))).alias("words"))
    plan = _word_stream(worded).select("word")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_without_benchmark_nothing_is_contaminated(messy, items):
    found = contamination(messy, items.limit(0))
    assert found.where("n_hit > 0 or n_items > 0").isEmpty()
    assert without_contaminated(messy, items.limit(0)).count() == len(TEXTS)


def test_suffix_and_substring_of_odd_rows(spark, messy):
    distinct = {1: "", 3: TEXTS[5][1], 4: TEXTS[6][1], 5: LONG, 6: LONG + "x", 7: TEXTS[11][1], 8: TEXTS[12][1]}
    docs = list(distinct.items())
    one_text = messy.where("doc_id is not null and text is not null and text not like 'another%'")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup(one_text).collect()}
    assert got == brute.substring_dedup(docs)
    rows = suffix_dedup(one_text).withColumn("kept", F.sha2("kept", 256)).collect()
    assert {r.doc_id: tuple(r[1:]) for r in rows} == brute.suffix_dedup(docs)
    nulls = substring_dedup(messy).where("doc_id is null").collect()
    assert sorted(r.n_removed for r in nulls) == [0, 16]


def test_hot_keys_are_cut_into_windows(spark):
    from starlode.llm import superkmers
    from starlode.llm.substrings import _kept_words, sorted_windows

    rng = np.random.default_rng(5)
    docs = []
    for i in range(60):
        extra = " ".join(rng.choice(list("abcdef"), rng.integers(0, 30)))
        docs.append((i, f"{extra} {SHARED} {extra}"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    shipment = superkmers.ship(df, 13, 5, True, F.col("doc_id"), F.col("text"), chunk_bytes=500, hot=3)
    rows = superkmers.repeated(shipment, sorted_windows, _kept_words, "doc_id long, n_words long, n_removed long, kept string")
    assert {r[0]: tuple(r[1:]) for r in rows.collect()} == brute.substring_dedup(docs)


def test_a_bucket_gets_one_row_per_chunk_and_text(spark):
    from starlode.llm import superkmers

    docs = [(i, SHARED) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    shipment = superkmers.ship(df, 13, 5, True, F.col("doc_id"), F.col("text"))
    plan = shipment.plan
    rows = [r for r in shipment.packets.collect() if r.bucket < plan.buckets]
    texts = sum(len(superkmers.unpack(r.payload)[1]) for r in rows)
    assert texts > 0
    assert all(len(a) <= len(p[1]) for p in map(superkmers.unpack, (r.payload for r in rows)) for a in p[1:])
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup(df).collect()}
    assert got == brute.substring_dedup(docs)


def test_maximal_repeats_list_all_occurrences(spark):
    a, b = "x" + SHARED + "y", "zz" + SHARED + "q"
    df = spark.createDataFrame([(1, a), (2, b), (3, SHARED[:60] + "#")], "doc_id long, text string")
    covered = {}
    for r in maximal_repeats(df).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.length))
    assert covered == {1: set(range(1, len(SHARED) + 1)), 2: set(range(2, len(SHARED) + 2)), 3: set(range(60))}


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(3)
    for _ in range(60):
        strings = [bytes(rng.choice([97, 98], rng.integers(1, 40))) for _ in range(rng.integers(1, 6))] + [b"a" * 30]
        data = np.frombuffer(b"".join(strings), np.uint8)
        offsets = np.r_[0, np.cumsum([len(s) for s in strings])]
        ends = np.repeat(offsets[1:], np.diff(offsets))
        order, rounds = suffix_array(data, ends)
        suffixes = [bytes(data[i : ends[i]]) for i in order]
        assert suffixes == sorted(suffixes)
        lcp = common_prefixes(data, ends, order, rounds, 3)
        for x, y, n in zip(suffixes, suffixes[1:], lcp[1:].tolist(), strict=False):
            same = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
            assert n == (same if same >= 3 else 0)
        left = np.array([-1 if i in offsets else data[i - 1] for i in order])
        found = {bytes(data[order[f] : order[f] + n]) for n, f, _, diverse, _ in intervals(lcp, left) if diverse}
        want = set()
        for part in {s[i:j] for s in strings for i in range(len(s)) for j in range(i + 3, len(s) + 1)}:
            at = [(k, i) for k, s in enumerate(strings) for i in range(len(s)) if s.startswith(part, i)]
            after = {strings[k][i + len(part) : i + len(part) + 1] or (k, i) for k, i in at}
            before = {strings[k][i - 1 : i] if i else (k, i) for k, i in at}
            if len(after) > 1 and len(before) > 1:
                want.add(part)
        assert found == want


@pytest.mark.parametrize("steps", [1, 3, 200])
def test_nearest_smaller_values(steps, monkeypatch):
    from starlode.llm import suffixes

    monkeypatch.setattr(suffixes, "_STEPS", steps)
    rng = np.random.default_rng(steps)
    for n in (1, 2, 40, 300):
        values = rng.integers(0, 6, n)
        for v in (values, np.sort(values), np.sort(values)[::-1], np.r_[np.arange(1, n), 0]):
            for equal in (True, False):
                want = [max((k for k in range(i) if v[k] < x or (equal and v[k] == x)), default=-1) for i, x in enumerate(v)]
                assert suffixes._nearest(v, equal).tolist() == want


def test_quality_counts_windows_exactly(spark):
    text = "a b c d a b c x a b c\n\na b\na b\n #|"
    row = quality(spark.createDataFrame([(text,)], "text string")).first().quality
    # a b c three times, and a b a b (lines two and three) joins windows only once
    words = text.split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 3)}
    assert (row.n_words, row.n_repeat_words, row.n_dup_lines, row.n_symbols) == (len(words), len(covered), 1, 2)
    assert row.base_failed and not row.kept
    with pytest.raises(ValueError):
        quality(spark.createDataFrame([(text, 1)], "text string, quality int"))


def test_rules_are_a_table(spark):
    df = spark.createDataFrame([(" ".join(f"the{i}" for i in range(60)),)], "text string")
    assert quality(df, rules=(Rule("n_words", 60, 60),)).first().quality.kept
    assert not quality(df, rules=(Rule("n_words", 61, None),)).first().quality.kept
    assert {r.measure for r in RULES} >= {"mean_word_chars", "symbol_ratio", "stop_word_ratio", "dup_line_ratio"}


def test_simhash_of_odd_rows(messy):
    rows = near_documents(messy).collect()
    empty = [r for r in rows if r.fingerprint == 0]
    assert len(empty) == 5 and {r.component_id for r in empty} == {1}
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    # the groups: empty texts, the null id, 3, both texts of 4, the two long ones, 7
    assert sorted(r.doc_id or 0 for r in one_per_group(messy).collect()) == [0, 1, 3, 4, 4, 5, 7]


@pytest.mark.parametrize("n", [2, 64, 65, 300])
@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_stars_against_all_distances(n, radius):
    rng = np.random.default_rng(n + radius)
    base = rng.integers(0, 2**63, max(1, n // 20), dtype=np.uint64)
    one = np.uint64(1)
    prints = base[rng.integers(0, len(base), n)]
    for _ in range(2):
        prints = prints ^ (one << rng.integers(0, 64, n).astype(np.uint64))
    prints = np.unique(prints)
    want, got = brute.Union(prints.tolist()), brute.Union(prints.tolist())
    for p in prints:
        for q in prints[np.bitwise_count(prints ^ p) <= radius]:
            want.join(int(p), int(q))
    for p, q in zip(*stars(np.zeros(len(prints), int), prints, radius), strict=True):
        got.join(int(p), int(q))
    assert [want.find(p) for p in prints.tolist()] == [got.find(p) for p in prints.tolist()]


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (None, 3)]
    df = spark.createDataFrame(links, "x long, y long")
    got = {r.node: r.component for r in components(df, "x", "y").collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {299: 299, 300: 299}
    assert got == want
    assert components(df.limit(0), "x", "y").count() == 0


def test_secrets_keep_the_base_matches(spark):
    text = "é token = 'abc' secret:token: abcdefgh AKIA" + "B" * 16 + " " + "0a" * 12 + " AKIAB passwd=xox ghp_" + "Zz" * 18
    df = spark.createDataFrame([(1, text), (1, text), (2, None), (None, "")], "doc_id long, text string")
    rows = scan(df).collect()
    assert sorted(len(r.spans) for r in rows) == [0, 0, 3, 3]
    # the first two values are too short, and so is the second match of AKIA; a match that is
    # dropped still takes the text it covers
    spans = [(s.kind, text[s.start : s.end]) for s in next(r for r in rows if r.spans).spans]
    assert spans == [("access", "AKIA" + "B" * 16), ("hex", "0a" * 12), ("github", "ghp_" + "Zz" * 18)]


def test_trigram_queries():
    assert trigram_query("[0-9a-f]{24,}") == []
    assert trigram_query("AKIA[A-Z0-9]+") == [{frozenset({"aki", "kia"})}]
    assert trigram_query("(abc|xy)z*") == []
    assert trigram_query("abc[0-9]+defg?") == [{frozenset({"abc"})}, {frozenset({"def"})}]


def test_mix_of_odd_rows(messy):
    rows = mix(messy, n_words(F.col("text"))).collect()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert {r.source_size for r in rows if r.doc_id == 2} == {0}
    by_source = {}
    for r in rows:
        by_source.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(t) - target) <= 1 for (_, target), t in by_source.items())


def test_lines_of_odd_rows(messy):
    rows = {}
    for r in line_dedup(messy, n_lines="lines_in", n_removed="lines_out").collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert rows[2][0].text is None and rows[1][0].text == "" and rows[8][0].text == " \n \t "
    assert rows[3][0].text == TEXTS[5][1]
    assert {(r.lines_in, r.lines_out) for r in rows[5]} == {(2, 0)}
    # its first line stands in document 5; its second shares two shingles of three
    assert (rows[6][0].lines_in, rows[6][0].lines_out) == (2, 1)
    with pytest.raises(ValueError):
        line_dedup(messy.withColumn("n_lines", F.lit(1)))


@pytest.mark.parametrize("letters", ["ab ", "abcdefghij é漢😀", "".join(map(chr, range(40, 400))), "a\0b"])
@pytest.mark.parametrize("n", [2, 9])
def test_packed_shingles_are_the_shingles(letters, n):
    from starlode.llm.lines import Shingles, shared, shingles, similar

    rng = np.random.default_rng(n)
    lines = {bytes([i]): "".join(rng.choice(list(letters), rng.integers(1, 40))) for i in range(40)}
    packed = Shingles(lines, n)
    for a, b in itertools.product(lines, lines):
        x, y = shingles(lines[a], n), shingles(lines[b], n)
        assert shared(packed.of(a), packed.of(b)) == len(x & y)
        assert similar(packed.of(a), packed.of(b), 0.5) == (2 * len(x & y) >= len(x | y))


def test_wide_keys_are_compared_in_blocks(spark, monkeypatch):
    from starlode.llm import lines

    monkeypatch.setattr(lines, "BLOCK", 8)
    base = "the quick brown fox jumps over the lazy dog and runs through the long dark forest at night " * 3
    docs = [(i, base + f" {i:03d}") for i in range(60)] + [(100, "something else entirely, on a line")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id for r in line_dedup(df).where("n_removed = 0").collect()}
    assert kept == {0, 100}


def test_wide_keys_compare_every_pair_of_blocks(spark, monkeypatch):
    from starlode.llm import lines

    monkeypatch.setattr(lines, "BLOCK", 4)
    one, other = "first family of template lines, " * 4, "second kind of line altogether; " * 4
    texts = ["neither of them, and the least of all"]
    texts += [f"{one}{i:02d}" for i in range(20)] + [f"{other}{i:02d}" for i in range(20)]
    keys = [[7] + [9] * (i in (1, 20)) for i in range(len(texts))]  # the small key leaves its pair to the wide one
    rows = [(bytes([i]), text, k) for i, (text, k) in enumerate(zip(texts, keys, strict=True))]
    df = spark.createDataFrame(rows, "line binary, text string, keys array<long>")
    groups = brute.Union([r[0] for r in rows])
    for r in lines._links(df, lines.SHINGLE, lines.SIMILARITY).collect():
        groups.join(bytes(r.a), bytes(r.b))
    assert [groups.find(r[0])[0] for r in rows] == [0] + [1] * 20 + [21] * 20


def test_language_of_odd_rows(spark, messy):
    model = fit(messy)
    rows = identify(messy, model).collect()
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 8)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows)
    nothing = fit(messy.limit(0))
    assert {r.lang_pred for r in identify(messy, nothing).collect()} == {"und"}


def test_archives_of_odd_pages(spark):
    big, other = "<p>é</p>" * 200, "<p>other</p>" * 200
    rows = [
        (1, "http://a", big, 1),
        (2, None, big, 2),
        (2, None, big, 2),
        (None, "http://n\r\nX: y", big, 3),
        (3, "http://c", None, 4),
        (4, "http://d", "", 5),
        (5, "http://e", "small", 6),
        (6, "http://f", "small", 7),
        (7, "http://g", other, 8),
        (None, "http://h", "WARC/1.1\r\n\r\n" * 500, 9),
        (8, "http://i", "<p>a very long page é</p>" * 100_000, 10),
        (9, "http://j", "<p>a very long page é</p>" * 100_000, 11),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in archive(pages).collect())
    size = len(big.encode())
    assert got == [
        (0, size, "revisit", 2),
        (0, 6000, "response", None),
        (1, size, "revisit", 2),
        (2, size, "response", None),
        (2, size, "response", None),
        (3, 0, "response", None),
        (4, 0, "response", None),
        (5, 5, "response", None),
        (6, 5, "response", None),
        (7, len(other), "response", None),
        (8, 2_600_000, "revisit", 9),
        (9, 2_600_000, "response", None),
    ]
    assert archive(pages.limit(0)).count() == 0


ODD = list("aAtTsSlL'rRve09.,<|>= \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u3000\u0338\u0301\u0308\u212a\u03a3\u03c3\xdf\u0130\ufb01漢😀\xe9\u200d\x00\xbd")


def test_tokens_of_odd_texts():
    rng = np.random.default_rng(11)
    parts = [*ODD, "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "'LL", "don't"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(4000)]
    want = brute.token_counts(list(enumerate(texts)), VOCABULARY)
    lookup = Lookup(read_definition(VOCABULARY))
    assert lookup.counts([t.encode() for t in texts]) == [want[i][1] for i in range(len(texts))]


def test_tokens_of_odd_rows(messy):
    rows = token_counts(messy, VOCABULARY, size=8).collect()
    texts = sorted((i is None, i or 0, t or "") for i, t, _ in TEXTS)
    want = brute.token_counts([(k, t) for k, (_, _, t) in enumerate(texts)], VOCABULARY)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in rows)
    assert got == sorted((*texts[k][:2], *want[k]) for k in want)


def test_long_texts_and_full_caches(monkeypatch):
    from starlode.llm import tokens

    monkeypatch.setattr(tokens, "_SEGMENT", 50)
    monkeypatch.setattr(tokens, "CACHE", 16)
    texts = [" ".join(f"Word{i * k}é, it's" for i in range(60)) for k in range(1, 6)] + [LONG]
    want = brute.token_counts(list(enumerate(texts)), VOCABULARY)
    lookup = Lookup(read_definition(VOCABULARY))
    assert lookup.counts([t.encode() for t in texts]) == [want[i][1] for i in range(len(texts))]
    assert len(lookup.table) <= 16 + len(set(LONG.split()))
    with pytest.raises(ValueError):
        read_definition(public_tokenizers.path("byte_bpe_50k.json"))


def test_frequent_words_of_all_partitions(spark):
    texts = [f"often again n{i} m{i}" + " third" * (i % 3 == 0) for i in range(600)]
    df = spark.createDataFrame([(t.encode(),) for t in texts], "text binary").repartition(40)
    words, counts = frequent(df, 64)
    found = dict(zip(words.split(), counts.tolist(), strict=True))
    assert {b"often", b"again", b"third"} <= set(found) and len(found) <= 64
    assert 600 - 2600 / 64 <= found[b"often"] <= 600
    kept = Frequent(2)
    kept.add([b"x" * 63] * 9 + [b"a"] * 5 + [b"b"] * 3 + [b"c"])
    assert kept.packed()[0].split() == [b"a", b"b"]


def test_merkle_trees_of_all_sizes(spark):
    sizes = {None: 1, "": 2, "a": 7, "b": 8, "c": 9, "d": 64, "e": 65, "\u00e9": 130, "z": 1}
    rows = [(i, g, f"leaf {g} {i}", f"leaf {g} {i}"[: -1 if i % 3 else None]) for g, n in sizes.items() for i in range(n)]
    rows += [(None, "z", "no id", "no id"), (3, "a", "leaf a 3", "leaf a 3")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string, altered string").repartition(7)
    found = manifest(df, "lang", "doc_id", "leaf").withColumn("folded", folded(F.col("altered"), F.col("path")))
    got = found.select("doc_id", "leaf", "subroot", "root", siblings(F.col("path")), "folded", "lang").collect()
    key = lambda r: tuple((x is not None, x or 0) if k == 0 else str(x) for k, x in enumerate(r))
    assert sorted((tuple(r)[:-1] for r in got), key=key) == sorted(brute.merkle(rows), key=key)
    whole = [r for r in got if r.folded == r.root]
    assert {(r.doc_id or 0) % 3 for r in whole} == {0} and len({r.root for r in got}) == 1


@pytest.mark.parametrize("n", [1, 2])
def test_merkle_tree_of_few_rows(spark, n):
    rows = [(i, "en", f"leaf {i}", f"leaf {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string, altered string")
    got = manifest(df, "lang", "doc_id", "leaf").select("doc_id", "leaf", "subroot", "root", siblings(F.col("path")))
    assert sorted(map(tuple, got.collect())) == [r[:5] for r in brute.merkle(rows)]


def test_digests_tell_fields_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "-"), ("-", None), ("é", "")], "x string, y string")
    got = [r[0] for r in df.select(digest(F.col("x"), F.col("y"))).collect()]
    assert got == [brute.sha(t) for t in ("1:a2:bc", "2:ab1:c", "-1:-", "1:--", "2:é0:")]


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(13)
    base = [(i, rng.normal(size=3).astype(np.float32).astype(float).tolist()) for i in range(150)]
    good = base + [(7, base[7][1]), (None, base[8][1]), (151, [1.0, -0.0, 5e-324])] + [(200 + i, base[0][1]) for i in range(80)]
    bad = [(300, None), (301, [1.0, None, 2.0]), (302, [1.0, float("nan"), 2.0]), (303, [float("inf")] * 3), (304, []), (305, [1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in good + bad], "vec_id long, embedding array<double>, n int")
    rows = whiten(df).collect()
    n, deviations, whitened, explained = brute.whitening([v for _, v in good])
    assert len(rows) == 3 * len(good) and {r.n for r in rows} == {n}
    got = sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in rows if r.component == 1)
    assert got == sorted((i is None, i or 0, d) for (i, _), d in zip(good, deviations, strict=True))
    for c in range(3):
        mine = {r.vec_id: r.whitened for r in rows if r.component == c + 1}
        pairs = np.array([(mine[i], w) for (i, _), w in zip(good, whitened[:, c], strict=True)])
        assert np.abs(np.abs(pairs[:, 0]) - np.abs(pairs[:, 1])).max() < 1e-9
    assert max(r.identity_error for r in rows) < 1e-9
    assert whiten(df.limit(0)).count() == 0 and whiten(df.where("vec_id >= 300")).count() == 1


def test_whitening_without_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0])], "vec_id long, embedding array<double>")
    rows = whiten(df).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(1, 0, None, None, None)}
    far = [(1, [1e300, 0.0]), (2, [-1e300, 0.5]), (3, [0.0, 0.0])]
    rows = whiten(spark.createDataFrame(far, df.schema)).collect()
    assert [r.deviation for r in rows if r.vec_id == 1] == [None, None]
    assert all(abs(r.whitened) < 2 for r in rows if r.component == 1)


@pytest.mark.parametrize("bits", [(0, 3, 7), (1, 0, 0), (20, 5, 30), (40, 40, 2)])
def test_cross_products_of_bit_planes(bits):
    rng = np.random.default_rng(sum(bits))
    for n in (1, 63, 64, 200):
        y = np.column_stack([rng.integers(0, 1 << b, n) for b in bits])
        whole = y.astype(object)
        assert (np.triu(cross_products(y, np.array(bits))) == np.triu(whole.T @ whole)).all()


def test_null_ids_are_spread(spark):
    from starlode.llm import mixing

    keyed, whole = [], mixing.materialize

    def watched(df, name):
        out = whole(df, name)
        if name == "mix-keys":
            keyed.append(out)
        return out

    mixing.materialize = watched
    try:
        df = spark.createDataFrame([(None, "a", f"w{i} x") for i in range(300)], "doc_id long, source string, text string")
        assert mix(df, n_words(F.col("text"))).count() == 300
    finally:
        mixing.materialize = whole
    assert keyed[0].select("key").distinct().count() == 300 and keyed[0].select("bin").distinct().count() > 5


def test_a_rare_language_is_learned(spark):
    rows = [(None, f"the quick brown fox number {i} jumps over lazy dogs", "en") for i in range(2000)]
    rows += [(5, f"zwölf boxkämpfer jagen viktor quer über den großen sylter deich {i}", "de") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(df, sample_docs=20)
    assert model.languages == ["de", "en"]
    found = identify(df, model).groupBy("lang_pred").count().collect()
    assert {tuple(r) for r in found} == {("en", 2000), ("de", 6)}


def test_language_by_exact_sets(spark):
    """The filter's answer against sets of n-grams, which have no false positives."""
    import re
    from collections import Counter

    rng = np.random.default_rng(8)
    kinds = {"a": "abcdef", "b": "defghi", "c": "éñüdeg"}
    words = {k: ["".join(rng.choice(list(v), rng.integers(2, 8))) for _ in range(60)] for k, v in kinds.items()}
    rows = [(i, " ".join(rng.choice(words[k], 30)), k) for i, k in enumerate(list(kinds) * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def grams_of(text):
        letters = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in text.encode())
        found = [letters[i : i + n] for n in (3, 5) for i in range(len(letters) - n + 1)]
        return [g for g in found if not re.search(rb"  ", g)]

    known = {}
    for k in kinds:
        times = Counter(g for _, t, lang in rows if lang == k for g in grams_of(t))
        sums = {n: sum(c for g, c in times.items() if len(g) == n) for n in (3, 5)}
        known[k] = {g for g, c in times.items() if c >= 2e-5 * sums[len(g)]}
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(df, fit(df)).collect()}
    for i, text, _ in rows:
        own = grams_of(text)
        share = {k: sum(g in s for g in own) / len(own) for k, s in known.items()}
        best = max(sorted(share), key=share.get)
        assert got[i][0] == best and abs(got[i][1] - share[best]) < 0.01
