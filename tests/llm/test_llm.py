"""The training-data operators against brute force on small tables and odd rows."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import __spark_entry__ as entry_points  # noqa: E402
import corpus_pipeline  # noqa: E402

from sensitext.llm import pii, sharding  # noqa: E402
from sensitext.llm.components import components  # noqa: E402
from sensitext.llm.decontaminate import find_leaks  # noqa: E402
from sensitext.llm.licences import LICENCES, licence_scan  # noqa: E402
from sensitext.llm.ngram_join import ngram_components  # noqa: E402
from sensitext.llm.packing import best_fit, bin_completion, lower_bound, pack  # noqa: E402
from sensitext.llm.quality_net import fit_quality, score_quality  # noqa: E402
from sensitext.llm.quality_rules import quality_rules  # noqa: E402
from sensitext.llm.repeats import remove_repeats  # noqa: E402
from sensitext.llm.suffix_array import suffix_array  # noqa: E402
from sensitext.llm.tokens import WordTokenizer, tokenizer_path  # noqa: E402
from sensitext.llm.training_order import feistel, read_order, write_training_order  # noqa: E402

COLUMNS = "doc_id bigint, text string, bucket string, size int, root int"


def noise(n, rng, words=("alpha", "beta", "Gamma,", "delta.", "été", "naïve", "x1")):
    return " ".join(rng.choice(words) + str(rng.randrange(60)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, copies, near copies, ties, clashing columns."""
    rng = random.Random(3)
    base = [noise(120, rng) for _ in range(6)]
    long = noise(20_000, rng)
    near = [b.replace("alpha1", "omega", 1) + " tail" for b in base]
    passage = noise(30, rng)
    texts = [None, "", " \t\n", "one", "one", "a b c", "a b c", *base, *near, *base[:2], long]
    texts += [long + " more", "aaaa" * 500, "ab " * 700, "ab " * 650, "x" * 3000]
    texts += [noise(40, rng) + "\n" + passage + "\n" + noise(40, rng) for _ in range(12)]
    rows = [(i * 7 % 101, t, "b", i, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# --- quality rules -------------------------------------------------------------------


def brute_counts(text):
    w = words_of(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {
        k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)
    }
    lines = [x for x in text.split("\n") if words_of(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules_equal_brute_force(odd):
    got = {r.doc_id: tuple(r)[1:7] for r in quality_rules(odd).collect()}
    assert got == {d: brute_counts(t) for d, t in texts_of(odd).items()}


def test_rules_keep_labelled_clean_documents(spark, data_dir):
    labels = spark.read.parquet(f"{data_dir}/labels.parquet")
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    rows = quality_rules(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)


# --- joins ---------------------------------------------------------------------------


def brute_components(texts, n, percent):
    sets = {}
    for d, t in texts.items():
        w = [x for x in t.encode().lower().split()]
        sets[d] = frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()
    root, links = {d: d for d in sets}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * len(sets[a] | sets[b]):
                    links[a] += 1
                    links[b] += 1
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: (len(s), find(d), links[d]) for d, s in sets.items()}


@pytest.mark.parametrize(
    "n, percent, options",
    [(4, 85, {}), (5, 80, {}), (2, 30, {"block_sets": 4}), (4, 85, {"bucket_bytes": 5000})],
)
def test_ngram_components_equal_brute_force(odd, n, percent, options):
    got = {r[0]: tuple(r)[1:] for r in ngram_components(odd, n, percent, **options).collect()}
    assert got == brute_components(texts_of(odd), n, percent)


def test_near_copies_with_random_edits(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(900)}" for _ in range(90)]
    rows = []
    for i in range(70):
        words = base.copy()
        for _ in range(rng.randrange(6)):
            words[rng.randrange(90)] = f"e{rng.randrange(9999)}"
        rows.append((i, " ".join(words), None, 0, 0))
    docs = spark.createDataFrame(rows, COLUMNS)
    for blocks in (2048, 9):
        got = {r[0]: tuple(r)[1:] for r in ngram_components(docs, 4, 85, block_sets=blocks).collect()}
        assert got == brute_components(texts_of(docs), 4, 85)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91)], "a bigint, b bigint")
    assert {r.id: r.root for r in components(edges).collect()} == {
        **dict.fromkeys(range(41), 0), 90: 90, 91: 90
    }


# --- personal data ---------------------------------------------------------------------

CARD = "4111 1111 1111 1111"


def brute_spans(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], pii.BASE_KINDS.index(s[0])))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(2)
    pieces = ["a@b.c", "@", "x_y", ".", "1.2.3.4", "256.1", "-", " ", "+", "4111", "1111", "(0)", "é", "@d.e"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(16)))
        mine = [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]
        assert mine == brute_spans(text), text


def test_checksums_context_and_redaction(odd):
    text = f"card {CARD}, IBAN DE89 3704 0044 0532 0130 00 and GB00 1234; ssn 078-05-1120."
    kinds = [s[0] for s in pii.find_spans(text)]
    assert kinds == ["card", "iban", "ssn"]
    assert pii.find_spans("call 078-05-1120") == []
    assert pii.redact(text, pii.find_spans(text)).startswith("card <CARD>, IBAN <IBAN> and GB00 1234; ssn <SSN>.")
    rows = pii.pii_report(odd).collect()
    assert len(rows) == odd.count() and all(r.spans == "" for r in rows)


# --- decontamination -------------------------------------------------------------------


def test_leaks_are_the_planted_items(spark, odd):
    rng = random.Random(11)
    vocabulary = [f"term{k}" for k in range(700)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) + "." for n in [8, 15, 40, 130] * 8]
    items = [f"{t[: len(t) // 2]}? {t[len(t) // 2 :]}" for t in items]
    benchmark = spark.createDataFrame(
        [*enumerate(items), (900, None), (901, ""), (None, "term1 term2")], "item_id bigint, text string"
    )
    planted = {(i, i) for i in range(0, 32, 3)}
    rows = []
    for i in range(32):
        filler = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(300))) for _ in "ab"]
        middle = items[i].upper() if i % 3 == 0 else ""
        rows.append((i, f"{filler[0]} {middle} {filler[1]}", None, 0, 0))
    docs = spark.createDataFrame(rows, COLUMNS).unionByName(odd.withColumn("doc_id", F.col("doc_id") + 500))
    for block in (1 << 20, 2000):
        got = {(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark, block_bytes=block).collect()}
        assert got == planted | {(7, None)}
    assert find_leaks(odd, benchmark.where("item_id > 899")).count() == 0


def test_items_that_share_an_id_leak_one_by_one(spark):
    texts = [" ".join(f"{x}{k}" for k in range(20)) + "." for x in "abcd"]
    benchmark = spark.createDataFrame(
        [(1, texts[0]), (1, texts[1]), (2, texts[2]), (2, None)], "item_id bigint, text string"
    )
    docs = spark.createDataFrame([(k, f"x {t} y", None, 0, 0) for k, t in enumerate(texts)], COLUMNS)
    for block in (1 << 20, 50):
        got = find_leaks(docs, benchmark, block_bytes=block).collect()
        assert sorted((r.doc_id, r.item_id) for r in got) == [(0, 1), (1, 1), (2, 2)]


# --- tokens, order, packing --------------------------------------------------------------


def test_words_give_the_ids_of_the_text():
    mine = WordTokenizer(tokenizer_path(), "<u4", memo_words=50)
    rng = random.Random(4)
    letters = "aAzé ÉßẞİΣςŉ́ \u0085\x1c's'\"1٣<|endoftext|> 漢字😀‍.,;:!?K÷\x00"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(14)))
        ids = mine.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == ids, text


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_feistel_is_a_permutation(n):
    assert sorted(feistel(np.arange(n), n, 5).tolist()) == list(range(n))


def test_training_order_round_trip(spark, odd, empty, tmp_path):
    folder = str(tmp_path / "order")
    total = write_training_order(odd, folder, seq_len=64, shard_slots=16)
    rows = read_order(spark, folder).collect()
    assert sorted(r.slot for r in rows) == list(range(total))
    assert all(r.offset == r.slot % 16 * (16 + 128) for r in rows)
    mine, ids = WordTokenizer(tokenizer_path(), "<u2"), defaultdict(bytes)
    for r in sorted(rows, key=lambda r: r.piece):
        ids[r.doc_id] += bytes(r.ids)
    assert ids == {d: mine.encode(t) + b"\1\0" for d, t in texts_of(odd).items()}
    late = read_order(spark, folder, first_slot=21).collect()
    assert {r.slot for r in late} == set(range(21, total))
    assert write_training_order(empty, str(tmp_path / "none")) == 0
    assert read_order(spark, str(tmp_path / "none")).count() == 0


def used(packing, limit):
    assert all(sum(k * n for k, n in fill) <= limit for fill, _ in packing)
    out = Counter()
    for fill, times in packing:
        for k, n in fill:
            out[k] += n * times
    return out, sum(t for _, t in packing)


def optimum(items, limit):
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - items[i]])
        place(i + 1, [*rooms, limit - items[i]])

    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(1)
    for _ in range(120):
        limit = rng.choice([10, 30, 50])
        items = sorted((rng.randint(1, limit) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = Counter(items)
        packed, n = used(bin_completion(counts, limit), limit)
        assert packed == counts and n == optimum(items, limit) >= lower_bound(counts, limit)
    counts = {1400: 100, 1300: 100, 1365: 99, 2100: 50}
    assert used(bin_completion(counts, 4096), 4096)[1] < used(best_fit(counts, 4096), 4096)[1]


def test_packed_pieces_are_gapless_and_whole(odd, empty):
    rows = pack(odd, limit=128).collect()
    mine, parts, sequences = WordTokenizer(tokenizer_path(), "<u4"), defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, t in texts_of(odd).items():
        ids = mine.encode(t) + np.array([1], "<u4").tobytes()
        own = sorted(parts[d], key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(ids) // 4, 128))
        assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[k : k + 512]) for k in range(0, len(ids), 512)]
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert pack(empty).count() == 0


# --- repeats -----------------------------------------------------------------------------


def test_suffixes_are_in_order():
    rng = random.Random(6)
    for _ in range(800):
        text = bytes(rng.randrange(rng.choice([1, 2, 4, 256])) for _ in range(rng.randrange(30)))
        text *= rng.choice([1, 1, 3])
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_repeats(texts, window):
    first, out = {}, {}
    rows = sorted((d, t.encode()) for d, t in texts.items())
    for d, b in rows:
        for i in range(len(b) - window + 1):
            first.setdefault(b[i : i + window], d)
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if first[b[i : i + window]] < d:
                gone[i : i + window] = b"\1" * window
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(c for c, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("window, options", [(50, {}), (20, {}), (50, {"group_records": 1, "bucket_bytes": 9000})])
def test_repeats_equal_brute_force(odd, window, options):
    got = {r[0]: tuple(r)[1:] for r in remove_repeats(odd, window, **options).collect()}
    assert got == brute_repeats(texts_of(odd), window)


# --- licences, sharding --------------------------------------------------------------------


def test_licence_texts_in_other_dress(spark):
    text = LICENCES["MIT"].replace("license", "licence").replace('"', "“").upper().replace("“", '"')
    rows = [(1, "Copyright (c) 2020 A B\n\n" + text), (2, "see MIT"), (3, None), (None, ""), (2, "see MIT")]
    rows.append((4, "x\n** Released under the MIT Licence **\ny"))
    found = licence_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(found) == 6
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].license == "MIT" and by_id[2].license is None and by_id[3].license is None
    assert (by_id[4].n_notices, by_id[4].notices) == (1, "MIT")


@pytest.mark.parametrize("limit", [300, 3000, 40_000, 1 << 30])
def test_shards_fit_and_split_only_where_needed(spark, odd, tmp_path, limit):
    extra = spark.createDataFrame([(5, "again", None, 0, 0)] * 9 + [(None, "n", None, 0, 0)], COLUMNS)
    docs = odd.unionByName(extra)
    rows = sharding.write_shards(docs, str(tmp_path / "shards"), limit).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    pages, total = defaultdict(list), Counter()
    for r in rows:
        pages[r.shard, r.page].append(r.bytes)
        for d in range(1, len(r.shard) + 1):
            total[r.shard[:d]] += r.bytes
    assert all(sum(p) <= limit or len(p) == 1 for p in pages.values())
    # Each parent of a shard was too large to stay whole.
    assert all(total[shard[:d]] > limit for shard, _ in pages for d in range(1, len(shard)))


# --- classifier, pipeline, registration -----------------------------------------------------


def test_classifier_on_rows_it_never_learnt_from(spark, odd, empty):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        bad = i % 3 == 0
        text = noise(60, rng)
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text, None, 0, 0, int(not bad)))
    table = spark.createDataFrame(rows, COLUMNS + ", quality int")
    net = fit_quality(table, table)
    scored = {r.doc_id: r.score for r in score_quality(table, net, "doc_id").collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(scored[i] >= 0.3) == (i % 3 != 0) for i in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in score_quality(odd, net, "doc_id").collect())
    assert score_quality(empty, net, "doc_id").count() == 0
    assert fit_quality(empty, table.where("false")).score(np.zeros(0, np.uint8), np.array([0, 0]))[0] == 0.5


def test_pipeline_stages_keep_clean_documents(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data_dir)
        rows = docs.collect()
        assert docs.columns == columns and 0.5 * n < len(rows) <= n, name
        docs = spark.createDataFrame(rows, docs.schema)
    assert not any(pii.find_spans(r.text or "") for r in rows)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, data_dir)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in rows}


def rows_without_own_ids(odd):
    """The odd rows and again each: without an id, under one id, and as exact repeats."""
    one = odd.withColumn("doc_id", F.lit(3).cast("bigint"))
    none = odd.withColumn("doc_id", F.lit(None).cast("bigint"))
    return odd.unionByName(none).unionByName(one).unionByName(odd.where("size < 9"))


def in_order(docs):
    rows = [(r.doc_id is None, r.doc_id or 0, r.text is not None, r.text or "") for r in docs.collect()]
    return [(None if r[0] else r[1], r[3]) for r in sorted(rows, key=lambda r: (*r[:3], r[3].encode()))]


def test_rows_without_own_ids_are_all_judged(odd):
    docs = rows_without_own_ids(odd)
    rows = in_order(docs)
    texts = {k: t for k, (_, t) in enumerate(rows)}
    brute = brute_components(texts, 4, 85)
    expected = Counter((rows[k][0], n, rows[c][0], links) for k, (n, c, links) in brute.items())
    assert Counter(map(tuple, ngram_components(docs, 4, 85).collect())) == expected
    left = brute_repeats(texts, 50)
    expected = Counter((rows[k][0], *left[k]) for k in left)
    assert Counter(map(tuple, remove_repeats(docs).collect())) == expected


def test_pipeline_stages_judge_every_row(spark, odd, tmp_path):
    docs = rows_without_own_ids(odd)
    rows = in_order(docs)
    brute = brute_components({k: t for k, (_, t) in enumerate(rows)}, 5, 80)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert in_order(kept) == [rows[k] for k, (_, c, _) in brute.items() if k == c]
    item = " ".join(f"item{k}" for k in range(30)) + "? the answer stands here."
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    leaking = [(i, f"before {item} after", None, 0, 0) for i in (3, None, 777)]
    table = docs.unionByName(spark.createDataFrame(leaking, COLUMNS))
    assert in_order(corpus_pipeline.decontaminated(spark, table, str(tmp_path))) == rows


def test_empty_tables(empty):
    assert ngram_components(empty).count() == 0
    assert remove_repeats(empty).count() == 0
    assert quality_rules(empty).count() == 0
    assert pii.pii_report(empty).count() == 0
    assert licence_scan(empty).count() == 0
    assert sharding.assign_shards(empty).count() == 0


@pytest.mark.parametrize("name", ["op1_quality_rules", "op8_licences", "op10_sharding"])
def test_query_equals_sql(spark, data_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data_dir}/documents.parquet'")
    frame = entry_points.queries()[name](spark, data_dir)
    columns = sorted(frame.columns)
    cursor = con.execute(entry_points.oracle_sql()[name])
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    theirs = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in frame.select(*columns).collect()) == theirs


def test_every_numbered_query_is_registered():
    names = entry_points.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
