"""The training-data operators against brute force on small tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tablegate.llm import features, fingerprint, langid, line_dedup, mixing, packing, quality_model, rules, sharding, simhash, toxicity
from tablegate.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_BIG, SF_MID, SF_SMALL

TOKENS = public_tokenizers.path("word_bpe_49k.json")
WORD_BYTES = b" \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_MID}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def words(text):
    return text.translate({c: " " for c in WORD_BYTES}).split(" ")


# --- SQL twins ---------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SF_SMALL)
    columns = sorted(df.columns)
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    sql = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert got == Counter(sql) and got


# --- SimHash -----------------------------------------------------------------------------


def plain_fingerprint(text):
    parts = [w for w in words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if w]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(codes, radius):
    """The least position of each code's class, by all pairs."""
    label = list(range(len(codes)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    a = np.array(codes, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= radius).tolist():
            x, y = sorted((root(i), root(i + 1 + j)))
            label[y] = x
    return [root(i) for i in range(len(codes))]


def test_simhash_equals_all_pairs(spark, texts, docs):
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    classes = plain_classes(prints, 2)
    want = {i: (f"{p:016x}", ids[c]) for i, p, c in zip(ids, prints, classes, strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == want and len(set(classes)) < len(ids)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()}


@pytest.mark.parametrize("limit", [2, 5, 10_000])
def test_hot_cells_lose_no_link(spark, scratch, limit):
    rng = np.random.default_rng(3)
    codes = set()
    for base in rng.integers(0, 1 << 63, 4, dtype=np.uint64).tolist():
        for _ in range(60):
            x = base
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << b
            codes.add(x)
    codes = sorted(codes)
    signed = [simhash._signed(c) for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    found = simhash.components(simhash.links(df, scratch + f"/{limit}", limit=limit), scratch + f"/c{limit}")
    to = {r.u: r.v for r in found.collect()}
    groups = defaultdict(set)
    for c in signed:
        groups[to.get(c, c)].add(c)
    want = defaultdict(set)
    for c, k in zip(signed, plain_classes(codes, 2), strict=True):
        want[k].add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_gray_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 12, 700, dtype=np.uint64))
    index = simhash.GrayIndex(codes)
    apart = np.arange(len(codes))
    q, c = index.search(codes, 2, apart, np.full(len(codes), -1))
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 2
    assert set(zip(q.tolist(), c.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))


# --- packing -----------------------------------------------------------------------------


def test_pieces_hold_every_id_once(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENS)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ids = {r.doc_id: [*plain.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    rows = packing.pack(docs, TOKENS).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert len(piece) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(piece.tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for spans, total in [*((v, len(ids[k])) for k, v in by_doc.items()), *((v, None) for v in by_sequence.values())]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == total if total is not None else at <= 2048
    assert sum(map(len, ids.values())) > 0.9 * 2048 * len(by_sequence)


@pytest.mark.parametrize("text", ["", " ", "a b", "x\x1cy \xa0z", "İstanbul ΣΑΣ é", "<|endoftext|> hi", "a <|endoftext|> b<|startoftext|>c.<|endoftext|>", "<|ENDOFTEXT|> <|endoftext|!", "don't I'LL", "日本 ﬁ ½²_y a1b2", "ẞ ß ... wh.?!"])
def test_word_by_word_ids_are_the_whole_texts(text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENS)
    assert packing.tokenizer(TOKENS)(text).tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("mark", list(".!?…。．｡！？؟۔।॥"))
def test_marks_of_all_scripts_end_sentences(mark):
    encode = packing.tokenizer(TOKENS)
    one, two = encode(f"日本 word{mark}"), encode("日本 word")
    assert encode.sentence_ends(one).tolist() == [len(one)] and encode.sentence_ends(two).tolist() == []
    both = np.concatenate((one, two, one))
    assert encode.sentence_ends(both).tolist() == [len(one), len(both)]


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(0)
    for _ in range(30):
        cuts = np.cumsum(rng.integers(1, 9, 12)).tolist()
        penalty = rng.integers(0, 6, 12).tolist()

        def cost(ends, cuts=cuts, penalty=penalty):
            at, total = 0, 0
            for e in ends:
                total += 10 - (e - at) + penalty[cuts.index(e)]
                at = e
            return total

        best = min(
            cost(ends)
            for m in range(1 << 11)
            if max(np.diff([0, *(ends := [c for i, c in enumerate(cuts[:-1]) if m >> i & 1] + cuts[-1:])])) <= 10
        )
        assert cost(packing.best_cuts(cuts, penalty, 10)) == best


# --- sharding ----------------------------------------------------------------------------


def plain_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        used, room = 1, middle
        for s in sizes:
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("ranges,finer", [(1 << 14, 1 << 8), (4, 2)])
def test_capacity_is_the_least(spark, docs, monkeypatch, ranges, finer):
    monkeypatch.setattr(sharding, "RANGES", ranges)
    monkeypatch.setattr(sharding, "FINER", finer)
    rows = docs.select(F.xxhash64("text").alias("key"), (F.octet_length("text") + 8).cast("long").alias("size"))
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"))
    ordered = [r.size for r in groups.orderBy("key").collect()]
    capacity, cuts = sharding.capacity_and_cuts(groups, 24)
    assert capacity == plain_capacity(ordered, 24) and cuts == sorted(cuts) and len(cuts) <= 23
    out = sharding.shard_rows(docs).join(docs, "doc_id").collect()
    totals, slots, shard_of = Counter(), defaultdict(list), defaultdict(set)
    for r in out:
        raw = (r.text or "").encode()
        assert r["size"] == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw)
        totals[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        shard_of[r.text].add(r.shard)
    assert max(totals.values()) == capacity and all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(out) == docs.count()


def test_a_hot_group_leaves_no_shard_empty(spark):
    rng = np.random.default_rng(4)
    sizes = {int(k): int(n) for k, n in zip(rng.integers(-(1 << 62), 1 << 62, 400), rng.integers(10, 100, 400), strict=True)}
    keys = sorted(sizes)
    sizes[keys[130]], sizes[keys[290]] = 12_000, 3_000
    groups = spark.createDataFrame(list(sizes.items()), "key long, size long")
    capacity, cuts = sharding.capacity_and_cuts(groups, 24)
    loads = Counter()
    for k in keys:
        loads[sum(k > c for c in cuts)] += sizes[k]
    parts = [[sizes[k] for k in x] for x in (keys[:130], keys[131:290], keys[291:])]

    def needed(part, room):
        return next((n for n in range(1, 25) if plain_capacity(part, n) <= room), 99)

    rest = next(c for c in range(100, 12_000) if sum(needed(p, c) for p in parts) <= 22)
    assert capacity == 12_000 and cuts == sorted(cuts) and sorted(loads) == list(range(len(cuts) + 1))
    assert sorted(loads.values())[-3:] == [rest, 3_000, 12_000] and len(loads) > 20


# --- mixing ------------------------------------------------------------------------------


def plain_budgets(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= full


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 50, None: 9}, {"a": 1000, "b": 1, "c": 2, "d": 7}])
def test_budgets_share_the_excess(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.budgets(df).collect()}
    want = plain_budgets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_meets_its_budgets(spark, docs):
    rows = mixing.mix(docs).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        n = sum(1 for w in words(r.text or "") if w)
        assert r["size"] == n and r.taken == n * r.times and 0 <= r.times <= 2
        sizes[r.source] += n
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], n)
    want = plain_budgets(sizes)
    for r in rows:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)
    again = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    assert again == {r.doc_id: r.taken for r in rows}
    copies = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert copies == Counter({r.doc_id: r.times for r in rows if r.times})


def test_repeated_rows_are_drawn_one_by_one(spark):
    # Three sources of equal rows: budgets 1.5 * 300 * (3, 1, 2) / 6, the first one capped at 2 epochs.
    rows = [(1, "x y", s) for s in "abc" for _ in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = {r.target: r.t for r in mixing.mix(df).groupBy("target").agg(F.sum("taken").alias("t")).collect()}
    assert len(got) == 3 and all(abs(target - t) <= 2 for target, t in got.items())


# --- fingerprints ------------------------------------------------------------------------


def test_edited_fingerprints(spark, docs, texts):
    ids = sorted(texts)
    rows = {r.doc_id: r for r in fingerprint.edited_fingerprints(docs, ranges=7).collect()}
    assert sorted(rows) == ids
    own = dict(zip(ids, fingerprint.text_form(fingerprint.sketches([texts[i] for i in ids])), strict=True))
    by_text = defaultdict(set)
    for k, i in enumerate(ids):
        following = texts[ids[(k + 1) % len(ids)]]
        m = len(texts[i]) // 2
        changed = texts[i][: len(texts[i]) - m] + following[:m]
        r = rows[i]
        assert r.n_chars == len(texts[i]) and r.fingerprint == own[i]
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        by_text[texts[i]].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert np.mean([r.near_edited for r in rows.values()]) > 0.3 > 0.02 > np.mean([r.near_next for r in rows.values()])
    assert np.mean([r.near_edited > r.near_next for r in rows.values()]) > 0.98


def test_equal_substrings_share_inner_phrases():
    rng = np.random.default_rng(5)
    core = "".join(rng.choice(list("abcdefgh  "), 3000))
    sets = []
    for shift in (0, 1, 17, 333):
        text = "".join(rng.choice(list("xyz "), shift)) + core
        row = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        of = np.zeros(len(row), np.int64)
        for _ in range(3):
            row, of = fingerprint.parse(row, of)
        sets.append(set(row.tolist()))
    assert all(len(sets[0] & s) > 0.9 * len(sets[0]) for s in sets)


def test_near_copies_are_like_at_every_length():
    rng = np.random.default_rng(11)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnop"), k)) for k in rng.integers(2, 9, 400)]
    for n in (20, 50, 100, 150, 190, 199, 210, 250, 300, 400, 1000):
        whole = [" ".join(rng.choice(vocabulary, n)) for _ in range(40)]
        # Each text, its near copy with two more characters, and an unrelated one of equal length.
        one, two, other = [[t[a:b] for t in whole] for a, b in ((0, n), (0, n + 2), (n + 2, 2 * n + 2))]
        one, two, other = map(fingerprint.sketches, (one, two, other))
        assert fingerprint.likeness(one, two).mean() > 0.6
        assert fingerprint.likeness(one, other).mean() < 0.2


def test_short_edits_keep_their_likeness():
    rng = np.random.default_rng(12)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnop"), k)) for k in rng.integers(2, 9, 400)]
    whole = [" ".join(rng.choice(vocabulary, 100))[:300] for _ in range(40)]
    cut = [fingerprint.edited(t, "the next one is this") for t in whole]
    assert {len(t) for t in cut} == {170}
    assert fingerprint.likeness(*map(fingerprint.sketches, (whole, cut))).mean() > 0.3


def test_periodic_texts_have_their_phrases():
    one, more, other = "abc" * 100, "abc" * 101, "acb" * 100
    a, b, c = fingerprint.sketches([one, more, other])[:, None]
    assert fingerprint.likeness(a, b) > 0.4 > 0.2 > fingerprint.likeness(a, c)
    d, e, f = fingerprint.sketches(["a" * 500, "a" * 90, "b" * 500])[:, None]
    assert fingerprint.likeness(d, e) == 1.0 and fingerprint.likeness(d, f) == 0.0


def test_texts_do_not_change_each_other(texts):
    some = [texts[i] for i in sorted(texts)[:40]] + ["", "a", "aaaaaaaa", "ab", "日本語テキスト"]
    alone = np.concatenate([fingerprint.sketches([t]) for t in some])
    assert (fingerprint.sketches(some) == alone).all()


# --- classifiers -------------------------------------------------------------------------


def test_languages_are_told_apart(spark, docs):
    rows = langid.predict_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.held_out for r in rows} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_phrases_are_longest_matches():
    rng = np.random.default_rng(2)
    texts = {"a": "".join(rng.choice(list("abc "), 300)), "b": "".join(rng.choice(list("abd "), 200))}
    edges, sizes = [], []
    place = langid._letter_classes("abcd")
    for t in texts.values():
        codes = place[langid._points(t)].tolist()
        moves = langid.suffix_automaton(codes)
        flat = np.array([(s, c, to) for s, m in enumerate(moves) for c, to in m.items()], dtype=np.int32)
        edges.append(tuple(flat.T))
        sizes.append(len(codes))
    parser = langid.Parser(["a", "b"], "abcd", edges, sizes)
    queries = ["".join(rng.choice(list("abcdé "), n)) for n in (0, 1, 5, 60, 400)]
    codes, offsets = parser.normalized(queries)
    got = parser.phrases(codes, offsets)
    for k in range(len(queries)):
        own = codes[offsets[k] : offsets[k + 1]]
        text = "".join(" abcd?"[c] for c in own)
        for j, learned in enumerate(texts.values()):
            n, at = 0, 0
            while at < len(text):
                size = 1
                while at + size < len(text) and text[at : at + size + 1] in learned and text[at] != "?":
                    size += 1
                n, at = n + 1, at + size
            assert got[k, j] == n


def toy_parser(learned, alphabet, **kw):
    place = langid._letter_classes(alphabet)
    edges = []
    for t in learned:
        moves = langid.suffix_automaton(place[langid._points(t)].tolist())
        edges.append(tuple(np.array([(s, c, to) for s, m in enumerate(moves) for c, to in m.items()], dtype=np.int32).T))
    return langid.Parser([str(k) for k in range(len(learned))], alphabet, edges, [len(t) for t in learned], **kw)


def plain_phrases(text, learned):
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in learned:
            size += 1
        n, at = n + 1, at + size
    return n


def test_phrases_cross_lanes(monkeypatch):
    rng = np.random.default_rng(21)
    # The third never meets the states of a parse from elsewhere: phrases of 7 or of 13 equal letters.
    learned = ["".join(rng.choice(list("abc "), 300)), "".join(rng.choice(list("abd "), 200)), "a" * 7 + "b", "a" * 13 + "c"]
    parser = toy_parser(learned, "abcd")
    queries = ["".join(rng.choice(list("abcd "), n)).strip() + "a" for n in (1, 2047, 2048, 2049, 5000, 9000)]
    queries += ["a" * 5000, "a" * 4099 + "b" * 3000, "abd" * 3000, learned[0].strip() * 40, "d" * 4096]
    queries = [" ".join(q.split()) for q in queries]
    want = [[plain_phrases(q, t) for t in learned] for q in queries]
    for lane, stride in ((2048, 128), (50, 7), (64, 64), (10_000, 128)):
        monkeypatch.setattr(langid, "LANE", lane)
        monkeypatch.setattr(langid, "STRIDE", stride)
        assert parser.phrases(*parser.normalized(queries)).tolist() == want
        assert parser.phrases(*parser.normalized(queries[::-1])).tolist() == want[::-1]


def test_tables_of_many_languages_are_bounded(monkeypatch):
    rng = np.random.default_rng(22)
    letters = "abcdefghijklmnopqrstuvwxyz"
    learned = ["".join(rng.choice(list(letters[k % 9 : k % 9 + 12]), 300)) for k in range(200)]
    queries = ["".join(rng.choice(list(letters), n)) for n in (3, 80, 2500)] + [learned[150], learned[7]]
    whole = toy_parser(learned, letters)
    monkeypatch.setattr(langid, "TABLE_BYTES", whole.table.nbytes // 4)
    small = toy_parser(learned, letters)
    assert small.table.nbytes <= langid.TABLE_BYTES < whole.table.nbytes and len(small.rare) > len(whole.rare)
    found = [p.phrases(*p.normalized(queries)) for p in (whole, small)]
    assert (found[0] == found[1]).all() and small.predict(queries)[0][3:] == ["150", "7"]


def test_copies_do_not_starve_a_language(spark):
    copies = spark.range(20_000).select(F.lit("x").alias("lang"), F.lit("z" * 20).alias("text"))
    few = [(lang, f"{i:020b}".replace("0", "a").replace("1", "b")) for lang, n in (("x", 100), ("y", 10)) for i in range(n)]
    model = langid.fit(copies.unionByName(spark.createDataFrame(few, "lang string, text string")))
    # Windows of 20 letters with a blank between: 60 of x, all 10 of y.
    assert dict(zip(model.languages, model.sizes, strict=True)) == {"x": 60 * 21 - 1, "y": 10 * 21 - 1}


SCRIPTS = {"cjk1": (0x4E00, 400), "cjk2": (0x4E00 + 300, 400), "el": (0x3B1, 17), "hy": (0x561, 38), "ka": (0x10D0, 33), "ru": (0x430, 32), "uk": (0x440, 32)}


def script_text(rng, name, n):
    first, letters = SCRIPTS[name]
    vocabulary = ["".join(map(chr, w)) for w in np.random.default_rng(first).integers(first, first + letters, (150, 4))]
    return " ".join(rng.choice(vocabulary, n))


def test_letters_of_all_scripts_count(spark):
    rng = np.random.default_rng(7)
    rows = [(name, script_text(rng, name, 60)) for name in SCRIPTS for _ in range(20)]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert set(model.alphabet) == {c for _, t in rows for c in t if c.isalpha()} and len(model.alphabet) > 500
    asked = [(name, script_text(rng, name, n)) for name in SCRIPTS for n in (5, 40) for _ in range(10)]
    queries = [t for _, t in asked]
    parsers = [langid.Parser(model.languages, model.alphabet, model.edges, model.sizes, dense) for dense in (0, 5, langid.DENSE, 10_000)]
    found = [p.phrases(*p.normalized(queries)) for p in parsers]
    assert all((f == found[0]).all() for f in found)
    assert [name for name, _ in asked] == parsers[2].predict(queries)[0]


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{SF_BIG}/documents.parquet"), spark.read.parquet(f"{SF_BIG}/labels.parquet")


def test_toxicity_on_held_out_labels(spark, big):
    rows = toxicity.score_documents(*big).join(big[1], "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.97
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.9


def test_quality_on_held_out_labels(spark, big):
    rows = quality_model.grade_documents(*big).join(big[1], "doc_id").where("held_out").collect()
    assert np.mean([r.kept == bool(r.quality) for r in rows]) > 0.97
    assert np.mean([r.kept for r in rows if r.quality]) > 0.98
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)


def test_risk_is_corrected_for_the_prior():
    rng = np.random.default_rng(0)
    n, prior = 4000, 0.2
    toxic = rng.random(n) < prior
    x = np.stack([rng.random(n) < np.where(toxic, 0.95, 0.02), rng.random(n) < 0.5], axis=1).astype(float)
    pos = np.stack([rng.random(800) < 0.95, rng.random(800) < 0.5], axis=1).astype(float)
    w, b = toxicity.fit_nnpu(pos, x, prior)
    assert w[0] > 3 * abs(w[1]) and ((x @ w + b > 0) == toxic).mean() > 0.95


def test_ordinal_thresholds_rise():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 2))
    y = np.digitize(x[:, 0] * 2 + rng.logistic(size=3000), [-1.0, 1.5])
    w, cut = quality_model.fit_ordinal(x, y, 3)
    assert abs(w[0] - 2) < 0.4 and abs(w[1]) < 0.2 and abs(cut[0] + 1) < 0.3 and abs(cut[1] - 1.5) < 0.3


# --- rules -------------------------------------------------------------------------------


def plain_measures(text):
    parts = [w for w in words(text) if w]
    seen, again = set(), 0
    for line in text.split("\n"):
        if any(w for w in words(line)):
            again += line in seen
            seen.add(line)
    windows = [tuple(parts[i : i + 5]) for i in range(len(parts) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return len(parts), sum(map(len, parts)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered)


def test_measures(spark, docs, texts):
    rows = rules.ledger(docs.select("doc_id", "text")).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_measures(texts[r.doc_id])
    df = rules.ledger(docs.select("doc_id", "text"))
    mask = rules.mask_of("v2")
    names = [n for n, _ in rules.rules()]
    for r in rules.ablation(df).collect():
        bit = 1 << names.index(r.rule)
        assert r.n_failed == sum(1 for x in rows if x.failed & bit)
        assert r.n_failed_alone == sum(1 for x in rows if x.failed & mask == bit)


# --- odd tables --------------------------------------------------------------------------

ODD = "doc_id long, text string, lang string, source string, size string, score string, place string, row string, fp string, `a.b` string"
LONG = "word " * 60_000 + "end. " * 3000
ODD_ROWS = [
    (None, "no id here at all. " * 3, "en", "s"),
    (1, None, None, None),
    (2, "", "en", "s"),
    (3, " \n\t ", "en", "s"),
    (4, LONG, "en", "s"),
    (5, "twin text one two three", "en", "s"),
    (5, "twin text one two three", "en", "s"),
    (6, "twin text one two three", "de", None),
    (7, "é\u0000x 日本 \U0001f600 #*$", None, "t"),
]


def operators(labels):
    return {
        "langid": langid.predict_documents,
        "lines": line_dedup.remove_boilerplate,
        "packing": lambda d: packing.pack(d, TOKENS),
        "sharding": sharding.shard_rows,
        "simhash": simhash.near_duplicates,
        "keep_one": simhash.keep_one,
        "mixing": mixing.mix,
        "mixed": mixing.mixed_documents,
        "fingerprint": fingerprint.edited_fingerprints,
        "fingerprints": fingerprint.fingerprints,
        "quality": lambda d: quality_model.grade_documents(d, labels),
        "toxicity": lambda d: toxicity.score_documents(d, labels),
        "rules": rules.ledger,
    }


WANT = {"lines": 9, "sharding": 9, "simhash": 9, "mixing": 9, "fingerprint": 9, "fingerprints": 9, "quality": 9, "toxicity": 9, "rules": 9, "langid": 9}


@pytest.mark.parametrize("name", sorted(operators(None)))
def test_odd_and_empty_tables(spark, name):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 1), (4, 1, 1), (None, 0, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    run = operators(labels)[name]
    odd = spark.createDataFrame([(*r, *["x"] * 6) for r in ODD_ROWS], ODD)
    rows = run(odd).collect()
    assert len(rows) == WANT.get(name, len(rows))
    empty = run(odd.limit(0)).collect() if name not in ("quality", "toxicity") else operators(labels.limit(0))[name](odd.limit(0)).collect()
    assert empty == []
    if name == "packing":
        assert {r.doc_id for r in rows} == {r[0] for r in ODD_ROWS} and sum(r.start == 0 for r in rows) == 9
    if name == "keep_one":
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, 1), (False, 4), (False, 5), (False, 7), (True, 0)]
    if name == "simhash":
        assert {r.doc_id: r.component_id for r in rows}[6] == 5 and {r.doc_id: r.component_id for r in rows}[3] == 1
    if name == "langid":
        assert {r.doc_id: r.lang_pred for r in rows}[1] == "und"


def test_labels_are_needed_for_nothing(spark):
    odd = spark.createDataFrame([(*r, *["x"] * 6) for r in ODD_ROWS], ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.score_documents(odd, none).collect()} != set()
    assert all(r.kept for r in quality_model.grade_documents(odd, none).collect())


def test_labels_of_unknown_documents_take_no_place(spark, scratch):
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    ids = spark.range(5000).select("id", (F.col("id") % 2).cast("int").alias("label"))
    rows = features.sampled(docs, ids, "doc_id", "text", 20, f"{scratch}/some", 1).collect()
    assert len(rows) == 20 and {r.label for r in rows} == {0, 1}
    rows = features.sampled(docs, ids, "doc_id", "text", 100, f"{scratch}/all", 1).collect()
    assert {(r.label, r.text) for r in rows} == {(i % 2, f"text {i}") for i in range(30)}


# --- lines -------------------------------------------------------------------------------


def test_boilerplate_goes_from_its_host_only(spark):
    head, own = "  Menu | Home ", "line of page {}"
    rows = [(i, f"{head}\n{own.format(i)}\n\nMenu | Home", "h") for i in range(10)]
    rows += [(100, "Menu | Home\nother", "g"), (101, "Menu | Home", "h"), (102, None, "h"), (103, "Menu | Home\nx", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.remove_boilerplate(df).collect()}
    assert all(out[i] == (f"{own.format(i)}\n", 3, 2) for i in range(10))
    assert out[100] == (rows[10][1], 2, 0) and out[101] == ("Menu | Home", 1, 0)
    assert out[102] == (None, 0, 0) and out[103] == ("Menu | Home\nx", 2, 0)
