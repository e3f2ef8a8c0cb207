"""Every operator against a brute-force version, and on odd rows: nulls, ties, empty tables."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from stratafold.llm import (
    common, encode, graph, katz, language, minhash, mixing, packing, quality, queries, simhash, topk, warc, wavelet)
from stratafold.session import new_folder

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fingerprint string, score int"
ODD = [
    (1, None, "en", "a", 0, "x", 1), (2, "", None, None, 0, "x", 1), (3, "  \n\t ", "en", "a", 5, "x", 1),
    (4, "the cat sat on the mat", "en", "a", 22, "x", 1), (4, "the cat sat on the mat", "en", "a", 22, "x", 1),
    (5, "der Hund und die Katze", "de", "b", 22, None, None), (None, "no id here, none", "en", None, 16, "x", 1),
    (6, "12 34 !!", "en", "b", 8, "x", 1), (7, "a " * 30_000, "en", "b", 60_000, "x", 1),
    (8, "x" * 70_000, "de", "b", 70_000, "x", 1), (9, "It's 'quoted', <|endoftext|> é É́", "en", "a", 30, "x", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SF, "documents")


def test_helpers(spark, odd, empty):
    assert list(common.groups_by_size([5, 5, 20, 1], 10)) == [(0, 2), (2, 3), (3, 4)]
    assert common.sampled_splits(empty, "doc_id", 4) == []
    splits = common.sampled_splits(spark.range(1000).repartition(3), "id", 8)
    assert splits[0] == 0 and splits == common.sampled_splits(spark.range(1000), "id", 8)
    assert len(common.sampled_splits(odd, "doc_id", 4)) <= 4


# --- 1 --------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    import xxhash

    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)] if words else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(prints):
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    return root


@pytest.mark.parametrize("block", [4096, 3])
def test_simhash_equals_brute_force(spark, docs, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    texts = {r.doc_id: r.text for r in docs.limit(120).collect()}
    base = "one two three four five six seven eight nine ten eleven twelve".split()
    for i in range(40):
        texts[10_000 + i] = " ".join(base * 12 + [f"w{i % 9}"])
    found = simhash.near_groups(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    want = {k: plain_fingerprint(t) for k, t in texts.items()}
    root = plain_groups(set(want.values()))
    least = {}
    for k, f in want.items():
        least[root(f)] = min(k, least.get(root(f), k))
    assert {r.doc_id: r.fingerprint & (1 << 64) - 1 for r in found} == want
    assert {r.doc_id: r.component_id for r in found} == {k: least[root(f)] for k, f in want.items()}


def test_simhash_index_loses_no_pair():
    rng = np.random.default_rng(0)
    from itertools import combinations
    for five in combinations(range(8), 5):
        assert any(all(m >> 8 * p & 0xFF == 0 or p in five for p in range(8)) for m in
                   (mask & (1 << 64) - 1 for mask in simhash.MASKS))
    for mask in simhash.MASKS:
        for finer in simhash.finer_masks(mask):
            assert (finer & mask) == mask and (finer & (1 << 64) - 1).bit_count() == 40
            assert all((m & (1 << 64) - 1).bit_count() == 52 for m in simhash.finer_masks(finer))
    fps = np.unique(rng.integers(-2 ** 63, 2 ** 63 - 1, 50))
    assert simhash.linked(fps) == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(200, 260)] + [(300, 301), (301, 300)]
    found = dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {**{i: 0 for i in range(41)}, 100: 100, **{i: 100 for i in range(200, 260)}, 300: 300, 301: 300}


def test_simhash_odd_rows(odd, empty):
    found = simhash.near_groups(odd).collect()
    assert len(found) == len(ODD)
    by = collections.defaultdict(set)
    for r in found:
        by[r.doc_id].add((r.fingerprint, r.component_id))
    assert by[1] == by[2] == by[3] == {(0, 1)} and len(by[4]) == 1
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == [1, 4, 5, 6, 7, 8, 9, None]
    assert simhash.near_groups(empty).count() == 0 and simhash.keep_one(empty).count() == 0


# --- 2 --------------------------------------------------------------------------------------------

def test_warc_round_trip_and_same_files_twice(spark, tmp_path):
    big = "<p>" + "same " * 400
    pages = [(i, f"http://h/{i} é", big if i % 3 == 0 else f"<p>{i}</p>", "extra") for i in range(40)]
    pages += [(100, None, None, "x"), (None, "u", "no id", "x"), (7, "u", big, "x"), (39, "u", big, "x")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, shard string")
    sums = []
    for n, parts in enumerate((1, 5)):
        path = f"{tmp_path}/w{n}"
        manifest = warc.write_warc(df.repartition(parts), path, file_bytes=800)
        sums.append(sorted((r.name, r.sha256) for r in manifest.collect()))
        assert len(sums[-1]) > 5
    assert sums[0] == sums[1]
    found = warc.read_warc(spark, path).collect()
    assert len(found) == len(pages)
    heads = [r for r in found if r.payload_bytes >= 1000 and r.record_type == "response"]
    assert [r.page_id for r in heads] == [39, 39]
    assert all(r.refers_to == 39 and r.payload is None for r in found if r.record_type == "revisit")
    html = {p[0]: (p[2] or "").encode() for p in pages if p[0] != 7}
    for r in found:
        if r.page_id in html:
            assert r.payload_digest == hashlib.sha1(html[r.page_id]).hexdigest()
            assert r.payload_bytes == len(html[r.page_id])
    empty = warc.write_warc(df.limit(0), f"{tmp_path}/none")
    assert empty.count() == 0 and warc.read_warc(spark, f"{tmp_path}/none").count() == 0


def test_warc_files_do_not_hang_on_the_session(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FEWEST_BYTES", 500)
    monkeypatch.setattr(warc, "FEW_SHARDS", 9)
    df = spark.createDataFrame([(i, None, f"<p>{i % 50}</p>" * 30) for i in range(200)],
                               "page_id bigint, url string, html string")
    before, sums = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in ("4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            rows = warc.write_warc(df, f"{tmp_path}/p{parts}").collect()
            sums.append(sorted((r.shard, r.seq, r.name, r.records, r.sha256) for r in rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sums[0] == sums[1] and len(sums[0]) == 9 and sum(r[3] for r in sums[0]) == 200
    assert max(r[3] for r in sums[0]) < 60


# --- 3 --------------------------------------------------------------------------------------------

def test_minhash_edited_texts_and_likeness(docs):
    found = {r.doc_id: r for r in minhash.edited_likeness(docs).collect()}
    texts = sorted((r.doc_id, r.text or "") for r in docs.collect())

    def shingles(text):
        words = re.split("[ \t\n\x0b\x0c\r]+", text.lower().strip(" \t\n\x0b\x0c\r"))
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words != [""] else set()

    off = []
    for i, (key, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        assert found[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[key].n_chars == len(text)
        for value, other in ((found[key].near_edited, edited), (found[key].near_next, following)):
            a, b = shingles(text), shingles(other)
            off.append(value - (len(a & b) / len(a | b) if a | b else 1.0))
    assert np.std(off) < 0.05 and abs(np.mean(off)) < 0.01 and np.abs(off).max() < 0.25


def test_minhash_odd_rows(odd, empty):
    found = minhash.edited_likeness(odd).collect()
    assert len(found) == len(ODD)
    by = {r.doc_id: r for r in found}
    assert by[1].fingerprint == by[3].fingerprint == "" and by[1].near_next == 1.0
    assert len({r.fingerprint for r in found if r.doc_id == 4}) == 1
    assert len(by[6].fingerprint) == 2 * minhash.BINS
    assert minhash.edited_likeness(empty).count() == 0
    one = minhash.edited_likeness(odd.where("doc_id = 5")).first()
    assert one.near_next == 1.0


# --- 4, 10 ----------------------------------------------------------------------------------------

def test_line_field_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    sizes, change = np.array([1, 4, 2]), rng.normal(size=(2, 2))
    node = rng.normal(size=7)
    good, pairs = quality.marginals(node, sizes, change)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    from itertools import product
    for n in sizes:
        total, one, two = 0, np.zeros(n), np.zeros((2, 2))
        for y in product((0, 1), repeat=int(n)):
            p = math.exp(sum(node[at + i] * y[i] for i in range(n)) + sum(change[a, b] for a, b in zip(y, y[1:])))
            total += p
            one += p * np.array(y)
            for a, b in zip(y, y[1:]):
                two[a, b] += p
        want += list(one / total)
        want_pairs += two / total
        at += n
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs)


def test_quality_held_out(spark):
    folder = SF.replace("0.001", "0.01")
    found = queries.QUERIES["op4_line_quality"](spark, folder).toPandas()
    marks = common.table(spark, folder, "labels").toPandas()
    both = found.merge(marks, on="doc_id")
    both = both[both.held_out]
    assert len(found) == common.table(spark, folder, "documents").count()
    assert (both.predicted == both.quality).mean() > 0.95
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()


def test_quality_and_language_odd_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    for labels, want in ((none, 0.5), (spark.createDataFrame([(4, 1), (5, 1)], "doc_id bigint, quality int"), 1.0)):
        assert quality.fit(odd, labels, held_out=(5, 9)) == want
    mixed = spark.createDataFrame([(4, 1), (5, 1), (6, 0), (7, 0), (None, 1), (8, None)], "doc_id bigint, quality int")
    scored = quality.score_quality(odd, quality.fit(odd, mixed, held_out=(5, 9))).collect()
    assert len(scored) == len(ODD) and all(0 <= r.quality_score <= 1 for r in scored)
    assert quality.score_quality(empty, 0.5).count() == 0
    model = language.fit(odd, held_out=(4, 9))
    assert model.languages == ("de", "en")
    found = language.identify(odd, model)
    assert "fingerprint" in found.columns and found.columns.count("score") == 1
    by = {r.doc_id: r for r in found.collect()}
    assert by[1].lang_pred == by[2].lang_pred == by[6].lang_pred == "und" and by[1].score == 0
    assert by[4].lang_pred == "en" and by[5].lang_pred == "de"
    unknown = language.identify(odd, language.fit(empty))
    assert {r.lang_pred for r in unknown.collect()} == {"und"}


def test_language_held_out(spark):
    folder = SF.replace("0.001", "0.01")
    found = queries.QUERIES["op10_language_id"](spark, folder).toPandas()
    both = found.merge(common.table(spark, folder, "documents").select("doc_id", "lang").toPandas(), on="doc_id")
    assert (both[both.held_out].lang_pred == both[both.held_out].lang).mean() > 0.97


@pytest.mark.parametrize("classes", [1, 2, 4, 7, 40])
def test_codewords_differ(classes):
    code = language.codewords(classes)
    assert len({tuple(row) for row in code}) == classes == len(code)
    if classes > 2:
        assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= code.shape[1] // 4


# --- 5 --------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op2_warc", "op5_top_products"])
def test_queries_with_sql(spark, name):
    db = duckdb.connect()
    for table in ("pages", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = db.sql(queries.SQL[name])
    found = queries.QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(want.columns)
    rows = sorted(map(str, (tuple(r) for r in found.select(*want.columns).collect())))
    assert rows == sorted(map(str, want.fetchall()))


def test_keep_one_keeps_a_row_of_each_group(spark):
    """Whatever their ids: repeated ids with several texts, copies without an id, rows that repeat."""
    a, b, c = ("one two three four five six seven eight", "quite another text, about nothing much at all",
               "und noch ein Text, der anders ist")
    data = [(1, a, 1), (1, b, 2), (2, a, 3), (2, b, 4), (None, a, 5), (None, c, 6), (None, c, 7), (3, None, 8), (4, "", 9),
            (5, "x y z", 10), (5, "x y z", 11)]
    found = []
    for parts in (1, 5):
        df = spark.createDataFrame(data, "doc_id bigint, text string, _id int").repartition(parts)
        kept = simhash.keep_one(df)
        assert kept.columns == df.columns
        found.append(sorted((tuple(r) for r in kept.collect()), key=str))
    assert found[0] == found[1]
    assert sorted(((i, t) for i, t, _ in found[0]), key=str) == sorted(
        [(1, a), (1, b), (None, c), (3, None), (5, "x y z")], key=str)


def test_top_k_of_very_long_vectors(spark, monkeypatch):
    """Long components take part; only a pair whose score no long can hold is left out."""
    monkeypatch.setattr(topk, "BLOCK", 4)
    data = [(0, [3.0, 4.0]), (1, [9e6, -9e6]), (2, [8e6, 8.5e6]), (50, [-1.0, 2.0]), (51, [1e15, 2e15]), (52, [1e200, 1.0]),
            (53, [1e306, 0.0]), (54, [float(2 ** 54), -3.0])]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>").selectExpr("*", "7 id", "'x' norm")
    vectors = topk.whole_vectors(df)
    used = {r.id: [int(x) for x in r.v] for r in vectors.collect()}
    assert sorted(used) == [0, 1, 2, 50, 51, 52, 54] and used[54] == [2 ** 62, -768]
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(vectors, vectors).collect()}
    want = {}
    for q, x in used.items():
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in used.items() if i != q)
        inside = [(-s, i) for s, i in scores if -2 ** 63 <= -s < 2 ** 63]
        want |= {(q, n): (i, s) for n, (s, i) in enumerate(inside[:5], 1)}
    assert found == want and len(want) > 10


def test_top_k_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "_SEED", 8)
    rng = np.random.default_rng(2)
    data = [(i, [float(v) for v in rng.normal(size=4) * (1 + i % 5)]) for i in range(150)]
    data += [(150 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)] + [(3, data[3][1])]
    data += [(900, None), (901, [1.0, None, 2.0, 3.0]), (902, [math.nan] * 4), (903, [math.inf] * 4), (904, []),
             (None, [1.0] * 4), (905, [1e30] * 4), (906, [0.5, 0.5])]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    vectors = topk.whole_vectors(df)
    used = [(r.id, [int(x) for x in r.v]) for r in vectors.collect()]
    assert {i for i, _ in used} == set(range(180)) | {904, 905, 906}
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(vectors.where("id % 50 = 0"), vectors).collect()}
    want = {}
    for q, x in used:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in used if i not in (q, 905))
            want |= {(q, n): (i, -s) for n, (s, i) in enumerate(scores[:5], 1)}
    assert found == want
    few = topk.top_k(vectors.where("id = 0"), vectors.where("id < 3"))
    assert few.count() == 2
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


# --- 6, 8 -----------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(encode.tokenizer_path())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, encode.END_ID]


def test_encoder_equals_the_library(docs, library):
    texts = [r.text for r in docs.collect()] + [t[1] for t in ODD] + [
        "don't 'S a's' !a. b!!c \x00 a\x00b", "KK i̇ İ ", "x\x85y \x1cz", "a,b;c'd", "y" * 3_000_000 + " z"]
    ids, sizes = encode.Encoder.of(encode.tokenizer_path()).encode(texts)
    at = 0
    for text, size in zip(texts, sizes):
        assert ids[at:at + size].tolist() == library(text)
        at += size


def test_wavelet_rank_select_access():
    ids = np.random.default_rng(1).integers(0, 300, 3000).astype(np.uint32) * 7
    w = wavelet.Wavelet.build(ids)
    assert (w.decode() == ids).all()
    assert [w.access(i) for i in range(0, 3000, 11)] == ids[::11].tolist()
    for symbol in (0, 7, 1400, 2093, 5):
        places = np.flatnonzero(ids == symbol)
        assert w.count(symbol) == len(places) and w.count(symbol, 1000) == (places < 1000).sum()
        assert [w.find(symbol, k) for k in range(len(places))] == places.tolist()
    one = wavelet.Wavelet.build(np.array([4], np.uint32))
    assert one.access(0) == 4 and one.decode().tolist() == [4]


def check_tokens(rows, texts, library):
    start = 0
    for r, text in zip(sorted(rows, key=lambda r: (r.start)), texts):
        ids = library(text)
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_files_round_trip(spark, docs, odd, empty, library):
    found = queries.QUERIES["op6_wavelet_tokens"](spark, SF).collect()
    check_tokens(found, [r.text for r in docs.orderBy("doc_id").collect()], library)
    path = new_folder(spark, "tokens")
    wavelet.write_tokens(odd, path, block_ids=50)
    rows = wavelet.read_tokens(spark, path).collect()
    check_tokens(rows, [t[1] for t in sorted(ODD, key=lambda t: t[0] if t[0] is not None else -1)], library)
    assert min(rows, key=lambda r: r.start).doc_id is None
    wavelet.write_tokens(empty, path + "e")
    assert wavelet.read_tokens(spark, path + "e").count() == 0


@pytest.mark.parametrize("parts", ["3", "16"])
def test_token_file_lookup_equals_plain_search(spark, docs, library, monkeypatch, parts):
    monkeypatch.setattr(wavelet, "FEWEST_ROWS", 25)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, "the null"), (None, ""), (5, None)]
    path, before = new_folder(spark, "tokens"), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        manifest = sorted(wavelet.write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), path,
                                               block_ids=2000).collect())
        store, folder = warc.open_folder(path)
        assert len(manifest) == min(wavelet.FEW_SHARDS, len(rows) // 25)
        everything = []
        for m in manifest:
            with store.open_input_file(f"{folder}/{m.name}") as stream:
                file = wavelet.TokenFile(stream)
                stream.seek(0)
                blocks = list(wavelet.read_blocks(stream))
                ids = np.concatenate([b[3].decode() for b in blocks])
                owner = [(int(k) if p else None, at) for b in blocks for k, p, n in zip(*b[:3]) for at in range(n)]
                assert len(file) == m.ids == len(ids) and len(blocks) == len(file.offsets) - 1
                everything.append((m.shard, ids, owner))
                assert file.count(1) == m.documents and file.read == 0
                for place in range(0, len(ids), 97):
                    seen = file.read
                    assert file.access(place) == ids[place] and file.read <= seen + 1
                    assert file.document(place) == owner[place]
                for symbol in {1, int(ids[0]), int(np.bincount(ids).argmax()), 49_000}:
                    places = np.flatnonzero(ids == symbol)
                    assert file.count(symbol) == len(places)
                    for stop in (0, 1, len(ids) // 2, len(ids) - 1, len(ids), len(ids) + 5):
                        assert file.count(symbol, stop) == (places < stop).sum()
                    some = range(0, len(places), 1 + len(places) // 20)
                    assert [file.find(symbol, k) for k in some] == places[list(some)].tolist()
                    for k in (-1, len(places)):
                        with pytest.raises(IndexError):
                            file.find(symbol, k)
                for place in (-1, len(ids)):
                    with pytest.raises(IndexError):
                        file.access(place)
        common_id = int(np.bincount(np.concatenate([e[1] for e in everything])).argmax())
        rare_id = int(everything[-1][1][0])
        counts = {r.token: r.n for r in wavelet.count_tokens(spark, path, [1, common_id, rare_id, 48_999]).collect()}
        for symbol in {1, common_id, rare_id}:
            want = sorted((shard, int(p), -1 if owner[p][0] is None else owner[p][0], owner[p][1])
                          for shard, ids, owner in everything for p in np.flatnonzero(ids == symbol))
            found = wavelet.find_token(spark, path, symbol).na.fill(-1, ["doc_id"])
            assert counts[symbol] == len(want) and sorted(tuple(r) for r in found.collect()) == want
        assert sum(e[1].tolist().count(48_999) for e in everything) == counts.get(48_999, 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def check_pieces(pieces, texts, library):
    of = collections.defaultdict(list)
    for p in pieces:
        of[p.doc_id].append(p)
    for key, own in of.items():
        ids = np.array(library(texts[key]), "<u4")
        copies = sum(p.length for p in own) // len(ids)
        assert sum(p.length for p in own) == copies * len(ids)
        for p in own:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
        if copies == 1:
            spans = sorted((p.start, p.start + p.length) for p in own)
            assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    padding = 0
    for parts in sequences.values():
        parts.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip([(0, 0), *parts], parts))
        size = sum(n for _, n in parts)
        assert size <= 2048
        padding += 0 if size & size - 1 == 0 else 2048 - size
    assert padding == 0
    return of


@pytest.mark.parametrize("group_ids", [packing.GROUP_IDS, 300])
def test_packing(spark, docs, odd, empty, library, monkeypatch, group_ids):
    monkeypatch.setattr(packing, "GROUP_IDS", group_ids)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(check_pieces(queries.QUERIES["op8_retrieval_packing"](spark, SF).collect(), texts, library)) == set(texts)
    texts = {t[0]: t[1] for t in ODD}
    assert set(check_pieces(packing.pack(odd).collect(), texts, library)) == set(texts)
    assert packing.pack(empty).count() == 0


def test_packing_signature_hangs_on_the_text_only(spark):
    texts = ["", "one", "two words", "the cat sat on the mat", "der Hund und die Katze"]
    data = [(i, texts[i * 7 % 5] if i % 3 else texts[i % 5]) for i in range(200)]
    signatures = collections.defaultdict(set)
    for rows in (data, data[::-1], data[:1], data[1:131]):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
        text_of = dict(rows)
        for r in df.select("doc_id", "text").mapInArrow(
                packing._token_rows(encode.tokenizer_path()),
                "id bigint, size bigint, sig bigint, ids binary, wide boolean, part int, term int, df bigint",
        ).where("term is null").collect():
            signatures[text_of[r.id]].add(r.sig)
    assert all(len(s) == 1 for s in signatures.values()) and 0 not in set.union(*signatures.values())
    assert len(set.union(*signatures.values())) == len(texts)


def plain_bm25(texts, library):
    """Each document's BM25 scores against all documents, term by term, k1 = 1.2 and b = 0.75."""
    bags = [collections.Counter(library(t)) for t in texts]
    sizes = [sum(b.values()) for b in bags]
    mean, n = sum(sizes) / len(sizes), len(bags)
    df = collections.Counter(t for b in bags for t in b)
    weight = [{t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * size / mean))
               for t, c in b.items()} for b, size in zip(bags, sizes)]
    return np.array([[sum(w.get(t, 0) for t in seed) for w in weight] for seed in bags])


@pytest.mark.parametrize("share", [0, 1 / 400, 0.2, 2])
def test_packing_lists_equal_brute_force_over_all_documents(spark, docs, library, monkeypatch, share):
    for name, value in (("GROUP", 37), ("SCORED", 50), ("SEEDS", 30), ("LEAST_SEEDS", 9), ("DENSE_SHARE", share)):
        monkeypatch.setattr(packing, name, value)
    caught = []
    plain_round = packing._round
    monkeypatch.setattr(packing, "_round", lambda spark, shards, *a: caught.append(shards) or plain_round(spark, shards, *a))
    docs = docs.limit(150).coalesce(1)
    packing.pack(docs)
    shards = caught[0].open()
    key = [t[0] for i in range(len(shards.files)) for t in shards.texts(i)]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(shards.files) > 3 and sorted(key) == sorted(texts)
    scores = plain_bm25([texts[k] for k in key], library)
    free = np.arange(len(key)) % 5 > 0
    for row, _, near, _ in shards.best(np.arange(len(key)), free, 7):
        own = np.where(free & (np.arange(len(key)) != row), scores[row], -np.inf)
        assert len(set(near.tolist())) == 7 and row not in near and free[near].all()
        assert np.allclose(own[near], np.sort(own)[::-1][:7], rtol=1e-5)


def test_packing_shards_part_languages(spark):
    """The centroids part texts that share few terms, whatever the order of the rows."""
    words = {"en": "the cat sat on a mat and then it went away from here".split(),
             "de": "der Hund liegt im Garten und die Katze schaut ihm lange zu".split()}
    rng = np.random.default_rng(2)
    data = [(i, " ".join(rng.choice(words["en" if i % 2 else "de"], 12))) for i in range(120)]
    found = []
    for rows in (data, data[::-1]):
        weights = packing._centroids(spark.createDataFrame(rows, "doc_id bigint, text string"), "text",
                                     encode.tokenizer_path())
        encoder = encode.Encoder.of(encode.tokenizer_path())
        found.append([int(weights[np.unique(encoder.encode([t], 1)[0] % packing._BINS)].sum(0).argmax())
                      for _, t in data])
    assert found[0] == found[1]
    assert not {k for k, (i, _) in zip(found[0], data) if i % 2} & {k for k, (i, _) in zip(found[0], data) if not i % 2}


@pytest.mark.parametrize("seeds, least", [(500, 95), (50, 60)])
def test_packing_finds_neighbours_in_other_shards(spark, monkeypatch, seeds, least):
    """Pairs of like texts, far apart and without a common id pair, share windows whatever the partitions."""
    for name, value in (("GROUP", 20), ("SEEDS", seeds), ("LEAST_SEEDS", seeds), ("LISTED", 4)):
        monkeypatch.setattr(packing, name, value)
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(3000)]
    topics = [rng.choice(vocabulary, 30, replace=False) for _ in range(100)]
    data = [(half * 100 + i, " ".join(rng.permutation(topic))) for half in (0, 1) for i, topic in enumerate(topics)]
    found = []
    for parts in ("4", "40"):
        monkeypatch.setattr(packing, "parts_of", lambda _, parts=parts: int(parts))
        df = spark.createDataFrame(data, "doc_id bigint, text string").coalesce(1)
        found.append({tuple(r) for r in packing.pack(df, window=64).collect()})
    assert found[0] == found[1]
    windows = collections.defaultdict(set)
    for r in found[0]:
        windows[r[5]].add(r[0] % 100)
    of = collections.defaultdict(set)
    for r in found[0]:
        of[r[0]].add(r[5])
    both = [bool(of[i] & of[i + 100]) for i in range(100)]
    assert sum(both) >= least


def windows_of(pieces, window):
    """The windows in order, each as (document, start) by place; the last ids, short of a window, are one."""
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length, p.doc_id, p.start))
    out, rest = [], []
    for _, parts in sorted(sequences.items()):
        places = [(doc, start) for _, _, doc, start in sorted(parts)]
        if sum(n for _, n, _, _ in parts) == window:
            out.append(places)
        else:
            rest += places[1:] if rest and places[0][0] == rest[-1][0] else places
    return [*out, rest] if rest else out


@pytest.mark.parametrize("window", [2048, 256])
def test_packing_windows_hold_the_best_unused_documents(spark, docs, library, monkeypatch, window):
    """Each window's first document is its seed, and each other one the best unused document of the table by plain BM25."""
    for name, value in (("GROUP", 37), ("SCORED", 50), ("LEAST_SEEDS", 9)):
        monkeypatch.setattr(packing, name, value)
    caught, plain_round = [], packing._round
    monkeypatch.setattr(packing, "_round", lambda spark, shards, *a: caught.append(shards) or plain_round(spark, shards, *a))
    docs = docs.limit(150).coalesce(1)
    pieces = packing.pack(docs, window=window).collect()
    key = [t[0] for i in range(len(caught[0].open().files)) for t in caught[0].texts(i)]
    texts = {r.doc_id: r.text for r in docs.collect()}
    row, scores = {k: i for i, k in enumerate(key)}, plain_bm25([texts[k] for k in key], library)
    unused, followers = set(range(len(key))), 0
    for (first, start), *others in windows_of(pieces, window):
        seed = row[first]
        if start == 0:
            assert seed == min(unused)
            unused.remove(seed)
        for doc, start in others:
            assert start == 0 and scores[seed][row[doc]] >= max(scores[seed][i] for i in unused) * (1 - 1e-5)
            unused.remove(row[doc])
            followers += 1
    assert not unused and followers > 50


@pytest.mark.parametrize("ids", [1, 7, 20, 0])
def test_packing_every_window_starts_with_a_seed(spark, docs, library, monkeypatch, ids):
    """Over rounds with short lists too, and whatever the ids."""
    for name, value in (("GROUP", 37), ("SCORED", 50), ("SEEDS", 6), ("LEAST_SEEDS", 2), ("LISTED", 3), ("MOST_SEEDS", 20),
                        ("LAST_SEEDS", 15)):
        monkeypatch.setattr(packing, name, value)
    caught, seeds, plain_round = [], set(), packing._round

    def watched(spark, shards, filler, fresh, listed):
        caught.append(shards)
        seeds.update(fresh.tolist(), filler.open)
        return plain_round(spark, shards, filler, fresh, listed)

    monkeypatch.setattr(packing, "_round", watched)
    data = [(i * ids + 3 * (ids == 20) if ids else None, r.text) for i, r in enumerate(docs.limit(200).collect())]
    found = packing.pack(spark.createDataFrame(data, "doc_id bigint, text string").coalesce(1)).collect()
    assert len(caught) > 3
    if not ids:
        assert sum(r.length for r in found) == sum(len(library(text)) for _, text in data)
        return
    check_pieces(found, dict(data), library)
    row = {t[0]: n for n, t in enumerate(t for i in range(len(caught[0].open().files)) for t in caught[0].texts(i))}
    windows = windows_of(found, 2048)
    assert {row[first] for (first, _), *_ in windows} <= seeds and len(windows) > 60


def test_packing_copies_take_few_rounds(spark, library, monkeypatch):
    """The seeds of many copies ask for different ones, so rounds do not grow with their number over a list's length."""
    for name, value in (("GROUP", 50), ("LISTED", 4), ("LAST_SEEDS", 8)):
        monkeypatch.setattr(packing, name, value)
    rounds, plain_round = [], packing._round
    monkeypatch.setattr(packing, "_round", lambda *a: rounds.append(plain_round(*a)) or rounds[-1])
    data = [(i, "the same words in each of these documents " * 3) for i in range(240)]
    found = packing.pack(spark.createDataFrame(data, "doc_id bigint, text string").coalesce(1), window=64).collect()
    assert sum(r.length for r in found) == 240 * len(library(data[0][1])) and len(rounds) < 40


@pytest.mark.parametrize("total", [1, 2047, 2048, 2055, 4096 + 1023])
def test_packing_cuts_leave_no_gap(total):
    rng = np.random.default_rng(total)
    stops = sorted({total, *rng.integers(1, total + 1, 9).tolist()})
    filled = collections.defaultdict(list)
    for first, stop in zip([0, *stops], stops):
        at = 0
        for start, length, sequence, offset in packing._cuts(first, stop - first, total, 2048):
            assert start == at and length > 0 and offset == sum(filled[sequence])
            filled[sequence].append(length)
            at += length
        assert at == stop - first
    sizes = [sum(filled[i]) for i in range(len(filled))]
    left = total % 2048
    assert sizes == [2048] * (total // 2048) + [1 << b for b in range(10, -1, -1) if left >> b & 1]


# --- 7 --------------------------------------------------------------------------------------------

def test_katz_equals_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 5000)
    found = {r.doc_id: r for r in queries.QUERIES["op7_katz_backoff"](spark, SF).collect()}
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), "end"] for r in docs.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in tokens}
    one, two = collections.Counter(), collections.Counter()
    for k, w in tokens.items():
        if not held[k]:
            one.update(w)
            two.update(zip(["end", *w], w))
    n, v = sum(one.values()), len(one)
    types = lambda c: [sum(x == r for x in c.values()) for r in range(1, katz.CUT + 2)]
    uni, factor = katz.Unigrams.of(n, v, types(one)), katz.Discounts.of(types(two)).factors
    below = lambda w: float(uni.probability(np.array([one.get(w, 0)]))[0])
    cut = lambda r: r * (factor[r - 1] if r <= katz.CUT else 1)
    mass, low = collections.Counter(), collections.Counter()
    for (h, w), r in two.items():
        mass[h] += cut(r)
        low[h] += below(w)

    def p(h, w):
        if not one.get(h):
            return below(w)
        left, share = 1 - mass[h] / one[h], 1 / one[h]
        if left < 1e-9:
            left = share = 1 / (one[h] + 1)
        return cut(two[h, w]) * share if two.get((h, w)) else left / (1 - low[h]) * below(w)

    assert abs(sum(p("end", w) for w in one) + p("end", "unseen") - 1) < 1e-9
    for k, w in tokens.items():
        r = found[k]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(x in one for x in w), n, held[k])
        assert math.isclose(r.score, sum(math.log10(p(h, x)) for h, x in zip(["end", *w], w)), rel_tol=1e-9)
        assert math.isclose(r.base_score, sum(math.log10((one.get(x, 0) + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
    out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_katz_odd_rows(odd, empty):
    found = katz.score_texts(odd).collect()
    assert len(found) == len(ODD) and all(math.isfinite(r.score) and r.score <= 0 for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (1, 2, 3)} == {1}
    assert katz.score_texts(empty).count() == 0
    none = katz.score_texts(odd.where("doc_id is null")).first()
    assert none.train_tokens == 0 and none.score == 0 and none.n_known == 0


def test_discounts_follow_good_turing():
    n = [1000, 400, 200, 110, 70, 50]
    common_part = 6 * n[5] / n[0]
    want = [((r + 1) * n[r] / (r * n[r - 1]) - common_part) / (1 - common_part) for r in range(1, 6)]
    assert np.allclose(katz.Discounts.of(n).factors, want)
    assert all(0 < d < 1 for d in katz.Discounts.of([5, 9, 1, 0, 0, 0]).factors)


# --- 9 --------------------------------------------------------------------------------------------

def test_mixing_equals_plain_raking(spark):
    rng = np.random.default_rng(5)
    data = [(i, "w " * int(rng.integers(1, 40)), f"s{rng.integers(3)}", ["en", "de", None][rng.integers(3)], f"t{rng.integers(2)}")
            for i in range(900)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string, lang string, topic string")
    goals = {"source": {"s0": .5, "s1": .3, "s2": .2}, "lang": {"en": .4, "de": .4, None: .2}, "topic": {"t0": .55, "t1": .45}}
    targets = {d: spark.createDataFrame(list(g.items()), "key string, share double") for d, g in goals.items()}
    found = mixing.mix(df, targets=targets, keep=0.3).collect()
    cells = collections.Counter()
    for _, t, s, la, to in data:
        cells[s, la, to] += len(t.split())
    total, fit = sum(cells.values()), {c: n / sum(cells.values()) for c, n in cells.items()}
    for _ in range(200):
        for i, d in enumerate(("source", "lang", "topic")):
            sums = collections.Counter()
            for c, w in fit.items():
                sums[c[i]] += w
            fit = {c: w * goals[d][c[i]] / sums[c[i]] for c, w in fit.items()}
    for r in found:
        c = (r.source, r.lang, r.topic)
        assert abs(r.mix_probability - fit[c] * total * 0.3 / cells[c]) < 1e-4
    kept = sum(r.mix_tokens for r in found if r.mix_kept) / total
    assert 0.2 < kept < 0.4
    assert {r.mix_gap for r in found} == {found[0].mix_gap} and found[0].mix_gap < mixing.CLOSE


def test_mixing_tells_the_gap_that_is_left(spark):
    """Targets that can be met are; unreachable ones are told by their gap."""
    data = [(i, "w " * n, s, la, "t") for i, (n, s, la) in enumerate(
        [(50, "a", "en"), (30, "a", "de"), (30, "b", "en"), (50, "b", "de"), (10, "c", "en")])]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string, lang string, topic string")
    goal = lambda **shares: spark.createDataFrame(list(shares.items()), "key string, share double")
    even = {"source": goal(a=.5, b=.45, c=.05), "lang": goal(en=.5, de=.5), "topic": goal(t=1.0)}
    assert mixing.mix(df, targets=even, keep=0.5).first().mix_gap < mixing.CLOSE
    crossed = {**even, "source": goal(c=1.0)}
    assert mixing.mix(df, targets=crossed, keep=0.5).first().mix_gap > 0.5


def test_mixing_odd_rows(odd, empty):
    found = mixing.mix(odd).collect()
    assert len(found) == len(ODD)
    by = {r.doc_id: r for r in found}
    assert by[1].mix_topic == "empty" and by[1].mix_kept and by[1].mix_probability == 1.0
    assert len({r.mix_kept for r in found if r.doc_id == 4}) == 1
    assert mixing.mix(empty).count() == 0
    assert queries.QUERIES["op9_mixing"]
