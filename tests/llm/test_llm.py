"""Training-data operators against brute force, and on odd tables: nulls, empty and long texts, ties, repeats, clashes."""

import base64
import gzip
import hashlib
import io
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from laurel.llm import (
    components, decontamination, embeddings, language, minhash, mixing, sharding, substrings, tasks, tokens, toxicity, warc,
)
from laurel.session import scratch_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators give to columns of their own.
CLASHES = "size int, row string, target string, shard int, slot int, score string, span int, part int, key string, copies string"
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))


def made(spark, rows, extra=False):
    schema = COLUMNS + (", " + CLASHES if extra else "")
    more = (1, "r", "t", 2, 3, "s", 4, 5, "k", "c") if extra else ()
    rows = [(i, t, lang, source, len(t or "")) + more for i, t, lang, source in rows]
    return spark.createDataFrame(rows, schema)


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"{r.choice('abcdefgh')}o{r.randrange(vocabulary)}" for _ in range(words))


def odd_rows():
    """Nulls, empties, ties, exact and near copies, a shared passage, a long text, a null id and source."""
    passage = prose(99, 40)
    rows = [(k, prose(k, 60 + k), "en", f"s{k % 3}") for k in range(12)]
    rows += [(20, None, None, None), (21, "", "en", "s0"), (22, " \t\n", "en", "s0"), (23, "one two", "en", "s1"), (24, "one two", "en", "s1")]
    rows += [(25 + k, prose(3, 63), "de", "s2") for k in range(5)]
    rows += [(40, prose(3, 63) + " tail", "de", "s2"), (41, prose(50, 30) + " " + passage, "fr", "s0"), (42, passage + "\n" + prose(51, 30), "fr", None)]
    rows += [(50, LONG, "en", "s0"), (51, LONG + " more", "en", "s1"), (None, passage, "en", "s0"), (None, None, None, "s0")]
    return rows


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Substring dedup


def brute_substrings(rows, size):
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w, gone = words(text), set()
        for k in range(len(w) - size + 1):
            source = first.get(tuple(w[k : k + size]))
            if source is not None and (i is None or source < i):
                gone |= set(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [4, 13])
def test_substrings_against_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 2000)
    rows = odd_rows()
    docs = made(spark, rows, extra=True).repartition(3)
    parsed = substrings.substring_dedup(docs, size).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in parsed), key=repr)
    assert got == brute_substrings([r[:2] for r in rows], size)
    texts = {r[0]: words(r[1]) for r in rows if r[0] is not None}
    for r in parsed:
        for f in r.factors if r.doc_id is not None else ():
            assert texts[f.ref_doc][f.ref_start : f.ref_start + f.length] == texts[r.doc_id][f.start : f.start + f.length]


def test_substrings_of_the_largest_id_and_of_rows_without_one(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 100)
    passage, last = prose(7, 40), 2**63 - 1
    rows = [(-(2**63), prose(1, 20)), (1, passage), (last, "own " + passage), (None, passage + " rest"), (None, prose(8, 40))]
    docs = made(spark, [(i, t, "en", "s") for i, t in rows]).repartition(5)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substrings.substring_dedup(docs, 13).collect()), key=repr)
    assert got == brute_substrings(rows, 13)
    assert (last, 41, 40, "own") in got and (None, 41, 40, "rest") in got


def test_substrings_of_nothing(spark):
    assert substrings.substring_dedup(made(spark, [])).count() == 0


def test_factor_boundaries():
    # Phrases at 0-2 from one reference and 3-5 from another: the second factor is what the first leaves.
    place = np.array([0, 1, 2, 3, 4, 5])
    found = substrings.factorise(place, np.array([1, 1, 1, 2, 2, 2]), np.array([7, 8, 9, 0, 1, 2]), 4)
    assert found == [(0, 6, 1, 7), (6, 3, 2, 3)]


# Embeddings


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    r = np.random.Generator(np.random.PCG64(3))
    base = r.standard_normal((20, 24))
    rows = []
    for k in range(160):
        v = base[k % 20] + r.standard_normal(24) * (0.02 if k % 3 else 0.17)
        rows.append((k, v.astype(np.float32).tolist(), k % 2))
    rows += [(200 + k, rows[5][1], rows[5][2]) for k in range(4)] + [(210, [2 * x for x in rows[5][1]], rows[5][2])]
    odd = [(300, None, 1), (301, [0.0] * 24, 1), (302, [float("nan")] * 24, 1), (303, [None] * 24, 1), (304, rows[0][1], None), (305, [], 1), (306, rows[0][1][:5], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as node", "2 as copies", "'x' as component")
    got = {x.vec_id: tuple(x)[1:] for x in embeddings.near_vectors(df).collect()}
    v = np.array([x[1] for x in rows], float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    label = np.array([x[2] for x in rows])
    near = (v @ v.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    forest = tasks.Forest(len(rows))
    for a, b in zip(*np.nonzero(near)):
        forest.join(int(a), int(b))
    ids = [x[0] for x in rows]
    for k, i in enumerate(ids):
        root = ids[forest.root(k)]
        assert got[i] == (int(near[k].sum()), root, root == i)
    assert near.sum() > 500
    for i, *_ in odd:
        assert got[i] == (0, i, True)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_collision_count_keeps_its_recall():
    needed = embeddings.collisions_needed()
    r = np.random.Generator(np.random.PCG64(1))
    axes = embeddings.directions(64, embeddings.COUNTED_PROJECTIONS)
    a = r.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = r.standard_normal((2000, 64))
    side -= (side * a).sum(1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * side
    hits = (np.abs((a - b) @ axes) <= embeddings.COUNT_WINDOW * np.sqrt(2 - 2 * 0.98)).sum(1)
    assert (hits >= needed).mean() >= 0.995


# MinHash


def brute_near(rows, shingle, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in rows:
        w = words((text or "").translate(lower))
        sets[i] = {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * len(sets[a] | sets[b]) and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("block", [1500, 4])
def test_near_duplicates_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = odd_rows()
    for k in range(30):
        w = prose(7, 120).split()
        for at in random.Random(k).sample(range(120), k % 5):
            w[at] = f"X{k}"
        rows.append((100 + k, " ".join(w), "en", "s0"))
    got = minhash.near_duplicates(made(spark, rows, extra=True), 3, 85, bands=21, rows=6).collect()
    want = brute_near([r[:2] for r in rows if r[0] is not None], 3, 85)
    assert {r.doc_id: tuple(r)[1:] for r in got if r.doc_id is not None} == want
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert len(got) == len(rows)


def test_drop_near_duplicates_keeps_columns_and_odd_rows(spark):
    docs = made(spark, odd_rows(), extra=True)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[None] == 2 and ids[20] == ids[21] == 1 and not any(i in ids for i in (24, 25, 29, 40, 51))
    assert minhash.near_duplicates(made(spark, [])).count() == 0


def test_super_minhash_estimates_jaccard():
    r = np.random.Generator(np.random.PCG64(5))
    a = r.integers(0, 2**64, 300, dtype=np.uint64)
    b = np.concatenate([a[:250], r.integers(0, 2**64, 50, dtype=np.uint64)])
    owner = np.repeat([0, 1, 2], [300, 300, 3])
    signs = minhash.super_minhash(np.concatenate([a, b, a[:3]]), owner, 3, 512)
    assert abs((signs[0] == signs[1]).mean() - 250 / 350) < 0.06
    assert np.isfinite(signs).all()


def test_components_against_union_find(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(None, 3), (5, 5)]
    forest = tasks.Forest(500)
    for a, b in edges:
        if a is not None:
            forest.join(a, b)
    got = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: forest.root(n) for n in {x for e in edges if None not in e and e[0] != e[1] for x in e}}


# Mixing


def test_mixing_counts_and_targets(spark):
    rows = [(k, prose(k, k % 37), "en", f"s{min(k % 7, 3)}") for k in range(900)] + odd_rows() + [(3, "again", "en", "s0")] * 3
    docs = made(spark, rows, extra=True)
    out = mixing.mixed_copies(docs).collect()
    again = mixing.mixed_copies(docs.repartition(5)).collect()
    key = lambda x: sorted((r.doc_id, r["size"], r.copies, r.target) for r in x if r.doc_id is not None)
    assert key(out) == key(again) and len(out) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, total, free = {}, sum(sizes.values()), set(names)
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3 * sizes[s] for s in over}
        free -= over
    target |= {s: level * weight[s] for s in free}
    taken = Counter()
    for r in out:
        source = r.row.source
        assert r.copies <= 3 and r.taken == r.copies * r["size"]
        assert r.target == pytest.approx(target[source]) and r.source_size == sizes[source]
        taken[source] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= 3 * max(len(words(t)) for _, t, _, x in rows if x == s)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in out)
    assert mixing.mix(made(spark, [])).count() == 0


# Token ids


def test_tokens_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = odd_rows()[:-2] + [(7000, "it's  two\n\n spaces\t\ttabs ,x", "en", "s"), (7001, "wide space　 and  x <|endoftext|> y", "en", "s")]
    folder = scratch_path(spark)
    tokens.write_tokens(made(spark, rows, extra=True), folder, path)
    got = {r.doc_id: tuple(r)[1:] for r in tokens.id_checksums(tokens.read_tokens(spark, folder)).collect()}
    own, at = Tokenizer.from_file(path), 0
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = own.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[i] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    some = tokens.read_tokens(spark, folder, [7, 40]).collect()
    assert {r.doc_id: r.start for r in some} == {7: got[7][0], 40: got[40][0]}
    empty = scratch_path(spark)
    tokens.write_tokens(made(spark, []), empty, path)
    assert tokens.read_tokens(spark, empty).count() == 0


# WARC


def page_rows():
    same = "<p>same</p>"
    return [(1, "http://a/1", same), (2, "http://a/2", same), (3, None, same), (4, "http://a/4", None), (5, "http://a/5", ""), (6, "http://a/\r\n6", "é" * 5000), (7, "u", "x\r\n\r\nWARC/1.1\r\nno")]


@pytest.mark.parametrize("compress", [True, False])
def test_warc_round_trip(spark, compress):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").selectExpr("*", "1 as digest", "'x' as payload")
    archives = warc.write_archives(warc.with_record_types(pages), scratch_path(spark), compress=compress)
    got = {r.page_id: tuple(r)[1:] for r in warc.page_records(warc.read_archives(archives)).collect()}
    largest = {}
    for i, _, html in page_rows():
        largest[html or ""] = max(i, largest.get(html or "", i))
    for i, _, html in page_rows():
        data, top = (html or "").encode(), largest[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert got[i] == (len(data), digest, "response" if i == top else "revisit", None if i == top else top)
    assert warc.write_archives(warc.with_record_types(pages.limit(0)), scratch_path(spark)).count() == 0


@pytest.mark.parametrize("compress", [True, False])
def test_warc_salvage(compress):
    records = [warc.record_bytes(k, f"http://a/{k}", f"page {k} ".encode() * 50, None, "2024-01-01T00:00:00Z") for k in range(6)]
    if compress:
        records = [gzip.compress(r) for r in records]
    starts = np.cumsum([0] + [len(r) for r in records])
    whole = bytearray(b"".join(records))
    ids = lambda rows: [r["record_id"] for r in rows if r["kind"] == "record"]
    name = lambda *ks: [f"<urn:page:{k}>" for k in ks]
    assert ids(warc.salvaged(io.BytesIO(bytes(whole)))) == name(*range(6))
    hurt = bytearray(whole)
    hurt[starts[2] + len(records[2]) // 2] ^= 0xFF
    rows = list(warc.salvaged(io.BytesIO(bytes(hurt))))
    assert ids(rows) == name(0, 1, 3, 4, 5)
    gap = [r for r in rows if r["kind"] == "gap"]
    assert [(g["offset"], g["length"]) for g in gap] == [(starts[2], starts[3] - starts[2])] and gap[0]["reason"]
    # Junk ahead, a record that is cut, and a cut end.
    torn = b"junk" * 9 + bytes(whole[: starts[3] - 20]) + bytes(whole[starts[3] : starts[6] - 7])
    rows = list(warc.salvaged(io.BytesIO(torn)))
    assert ids(rows) == name(0, 1, 3, 4) and sum(r["length"] for r in rows) == len(torn)
    assert [r["kind"] for r in warc.salvaged(io.BytesIO(b""))] == []


def test_warc_salvage_inside_members():
    records = [warc.record_bytes(k, f"http://a/{k}", random.Random(k).randbytes(3000), None, "2024-01-01T00:00:00Z") for k in range(10)]
    starts = np.cumsum([0] + [len(r) for r in records])
    ids = lambda rows: [int(r["record_id"][10:-1]) for r in rows if r["kind"] == "record"]
    hurt = bytearray(b"".join(records))
    hurt[starts[4] + 1500] ^= 0xFF
    packed = gzip.compress(bytes(hurt))
    # A bad record between good ones, in an archive between two whole members.
    ends = [gzip.compress(records[0]), gzip.compress(records[1])]
    rows = list(warc.salvaged(io.BytesIO(ends[0] + packed + ends[1])))
    assert ids(rows) == [0, 0, 1, 2, 3, 5, 6, 7, 8, 9, 1]
    gap = [r for r in rows if r["kind"] == "gap"]
    assert [(g["offset"], g["inner"], g["inner_length"]) for g in gap] == [(len(ends[0]), starts[4], len(records[4]))]
    assert "digest" in gap[0]["reason"] and sum(r["length"] for r in rows) == len(ends[0] + packed + ends[1])
    # What unpacks ahead of a cut end, or of damage to the packed bytes, is kept, and later members are found.
    whole = gzip.compress(b"".join(records))
    cut = list(warc.salvaged(io.BytesIO(whole[: len(whole) * 7 // 10] + ends[1])))
    assert ids(cut)[:6] == [0, 1, 2, 3, 4, 5] and ids(cut)[-1] == 1 and any(r["kind"] == "gap" for r in cut)
    torn = bytearray(gzip.compress(b"".join(records), 0))
    torn[-8:-4] = b"\0\0\0\0"
    rows = list(warc.salvaged(io.BytesIO(bytes(torn) + ends[1])))
    assert ids(rows) == [*range(9), 1] and "gzip" in [r for r in rows if r["kind"] == "gap"][0]["reason"]
    # Without digests records rest on the checksum of the member.
    bare = [re.sub(rb"WARC-(Block|Payload)-Digest: [^\r]*\r\n", b"", r) for r in (warc.record_bytes(k, None, prose(k, 300).encode(), None, "2024-01-01T00:00:00Z") for k in range(10))]
    torn = bytearray(gzip.compress(b"".join(bare)))
    assert ids(warc.salvaged(io.BytesIO(bytes(torn)))) == [*range(10)]
    torn[len(torn) // 2] ^= 0xFF
    assert ids(warc.salvaged(io.BytesIO(bytes(torn)))) == []
    # A limit bounds records, not members.
    assert ids(warc.salvaged(io.BytesIO(whole), most=5000)) == [*range(10)]
    large = warc.record_bytes(70, None, b"x" * 40000, None, "2024-01-01T00:00:00Z")
    rows = warc.salvaged(io.BytesIO(gzip.compress(records[0] + large + records[1])), most=5000)
    assert ids(rows) == [0, 1]


def test_warc_read_errors_are_no_gaps(spark, tmp_path, monkeypatch):
    data = b"".join(gzip.compress(warc.record_bytes(k, None, random.Random(k).randbytes(1000), None, "2024-01-01T00:00:00Z")) for k in range(600))

    class Failing(io.BytesIO):
        def read(self, n=-1):
            if self.tell():
                raise OSError("lost mount")
            return super().read(n)

    class Store:
        def open_input_file(self, path):
            return Failing(data)

    monkeypatch.setattr(warc, "file_system", lambda path: (Store(), path))
    with pytest.raises(OSError, match="lost mount"):
        list(warc.archive_rows("x"))
    monkeypatch.undo()
    folder = lambda path: spark.createDataFrame([(path, 2)], "path string, records long")
    # A folder cannot be read; a missing file is a gap, and an error where records are counted.
    with pytest.raises(Exception, match="directory"):
        warc.read_archives(folder(str(tmp_path))).collect()
    missing = folder(f"{tmp_path}/none.warc")
    assert [r.kind for r in warc.read_archives(missing).collect()] == ["gap"]
    with pytest.raises(Exception, match="0 of 2 records"):
        warc.read_archives(missing, counted=True).collect()
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    archives = warc.write_archives(warc.with_record_types(pages), str(tmp_path / "archives"))
    assert warc.read_archives(archives, counted=True).where("kind = 'record'").count() == len(page_rows())
    more = archives.selectExpr("path", "records + 1 as records")
    with pytest.raises(Exception, match="records can be read"):
        warc.read_archives(more, counted=True).collect()


# Language


def test_language_learns_and_predicts(spark):
    r = random.Random(2)
    syllables = {"aa": ["th", "er", "on", "ing"], "bb": ["eau", "oi", "ç", "ê"], "cc": ["sch", "ö", "ung", "ch"]}
    rows = []
    for k in range(300):
        lang = r.choice(list(syllables))
        rows.append((k, " ".join("".join(r.choices(syllables[lang], k=3)) for _ in range(20)), lang, "s"))
    odd = [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "12 34 !!", "bb", "s"), (903, "thering on", None, "s"), (None, "thonering", "aa", "s")]
    docs = made(spark, rows + odd, extra=True)
    got = language.language_of_documents(docs).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: lang for i, _, lang, _ in rows}
    for x in got:
        assert 0 <= x.score <= 1
        if x.doc_id in truth:
            assert x.lang_pred == truth[x.doc_id]
            assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
    named = {x.doc_id: x.lang_pred for x in got}
    assert named[900] == named[901] == named[902] == "und" and named[903] == "aa"
    kept = language.keep_known_languages(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) + 2
    assert language.language_of_documents(made(spark, [])).count() == 0


def test_texts_stay_where_no_language_was_learnt(spark):
    docs = made(spark, [(1, "some words", None, "s"), (2, "12 !!", None, "s"), (3, None, None, "s"), (4, "", None, "s"), (None, "é", None, "s")])
    kept = language.keep_known_languages(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, None}


def test_profile_ranks_by_hand():
    known = language.Profiles({"x": list(language.ranked(*language.counted(language.grams("aaab")), 300)), "y": []}, 300)
    assert known.judge("aaab") == ("x", 1.0)
    assert known.judge("zzz")[1] < 0.35 and known.judge("1 2") == ("und", 0.0)


# Decontamination


def test_leaks(spark):
    items = [
        (1, "Tom has 12 apples and gives 5 kg of them to Anna before the long winter came to the old town"),
        (2, prose(1, 25)), (3, "too short"), (4, None), (None, prose(2, 20)), (5, "Nothing like this is found in any text of the whole corpus today"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as id", "'k' as key")
    again = items[0][1].replace("12", "31").replace("5 kg", "8 miles").replace("Anna", "Bertha")
    mixed_up = "Tom has 12 apples and 7 apples. Tom has 12 apples"
    rows = [
        (10, "before it " + again + " and after", "en", "s"), (11, prose(60, 200) + " " + prose(1, 25).upper() + " " + prose(61, 50), "en", "s"),
        (12, prose(62, 300), "en", "s"), (13, mixed_up, "en", "s"), (14, None, "en", "s"), (15, "", "en", "s"), (16, "too short", "en", "s"),
        (17, prose(1, 25).replace(" ", ", "), "en", "s"), (18, LONG + " " + items[0][1], "en", "s"), (None, items[0][1], "en", "s"),
    ]
    docs = made(spark, rows, extra=True)
    found = decontamination.leaks(docs, benchmark)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == {(10, 1), (11, 2), (17, 2), (18, 1)}
    clean = decontamination.drop_leaked(docs, benchmark)
    # The copy without an id goes as well: rows are judged by their texts.
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {12, 13, 14, 15, 16}
    assert decontamination.leaks(docs, benchmark.limit(0)).count() == 0 and decontamination.leaks(docs.limit(0), benchmark).count() == 0


def test_short_items_need_more_than_a_phrase(spark):
    items = [
        (1, "What is the capital of France and why"), (2, "she went to the market to buy ten loaves"),
        (3, "Who wrote the book of songs"), (4, "If a train goes 60 km in 2 hours how far does it go in 5 hours at that speed"),
        (5, prose(70, 40)),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    words = [t.split() for _, t in items]
    clean = [
        "Many ask what is the capital of something here", "yesterday he went to the market to see a friend",
        "nobody knows who wrote the book of Psalms at all", "if a train goes 60 km in 2 hours it is slow",
        " ".join(words[4][:12]) + " and then something else altogether",
    ]
    leaked = {k: prose(80 + k, 50) + " so: " + t + ". " + prose(90 + k, 50) for k, t in items}
    again = items[3][1].replace("60", "90").replace("2 hours", "3 hours").replace("5 hours", "7 hours")
    capital = items[0][1].replace("France", "Peru")
    rows = [(i, t, "en", "s") for i, t in enumerate(clean)] + [(100 + k, t, "en", "s") for k, t in leaked.items()]
    rows += [(204, again, "en", "s"), (201, "Tell me. " + capital, "en", "s")]
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(made(spark, rows), benchmark).collect()}
    assert got == {(100 + k, k) for k in leaked} | {(204, 4), (201, 1)}


def test_slots_have_to_agree(spark):
    item = "From 3 boxes take 4 pens then 5 cups then 6 jars then 7 pots and see what is left over"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = "From 8 boxes take 8 pens then 2 cups then 6 jars then 9 pots and see what is left over"
    other = item.replace("4", "3").replace("5", "3").replace("6", "3").replace("7", "3")
    twice = spark.createDataFrame([(2, other)], "item_id long, text string")
    docs = made(spark, [(1, same, "en", "s")])
    assert decontamination.leaks(docs, benchmark).count() == 1
    # One value of the item would have to be four values of the document.
    assert decontamination.leaks(docs, twice).count() == 0


def fair(rounds, seed):
    r = random.Random(seed)
    names, fruit = ["cook", "smith", "judge", "miller"], ["pears", "plums", "figs", "nuts"]
    return " ".join(f"In round {k + 1} of the fair she sold {r.randint(2, 40)} ripe {r.choice(fruit)} to the {r.choice(names)}." for k in range(rounds))


def test_verbatim_copies_of_repeated_clauses(spark):
    items = [(k, fair(3 + k % 4, k)) for k in range(80)]
    # Sentences on Anna, Bertha and others: names as slots of a template that repeats.
    items += [(80 + k, " ".join(f"then on that day {a} gave the ball to {b} again," for a, b in zip(x, x[1:]))) for k in range(20) for x in [random.Random(k).sample(["Anna", "Bertha", "Carla", "Dora", "Emma", "Frida"], 5)]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = made(spark, [(i, prose(900 + i, 20) + ". " + t + " " + prose(400 + i, 20), "en", "s") for i, t in items])
    found = {r.item_id: r for r in decontamination.leaks(docs, benchmark).where("doc_id = item_id").collect()}
    assert set(found) == {i for i, _ in items} and min(r.consistency for r in found.values()) == 1.0


def test_verbatim_copies_of_many_slots(spark):
    items = [(1, "from 3 kg to 5 kg in 2 hours"), (2, "12 7 19 30 4 8"), (3, "add 12 km 7 m and 30 cm 4 mm to 8 km 9 m")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, prose(70 + i, 30) + " " + t + " " + prose(80 + i, 30), "en", "s") for i, t in items]
    # Other numbers in other words are no copy.
    rows += [(9, prose(90, 30) + " 13 8 20 31 5 9 " + prose(91, 30), "en", "s"), (10, "to 4 kg after 6 km by 9 days", "en", "s")]
    found = decontamination.leaks(made(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 2), (3, 3)} and {r.share for r in found} == {1.0}


# Toxicity


def test_toxicity_on_held_out_rows(spark):
    rows, labels = [], []
    bad = ["vexor", "grumol", "skarn", "plivet"]
    for k in range(600):
        text, toxic = prose(k, 40).split(), k % 4 == 0
        if toxic:
            for at in random.Random(k).sample(range(40), 4):
                text[at] = random.Random(k + at).choice(bad)
        rows.append((k, " ".join(text), "en", "s"))
        labels.append((k, 1, int(toxic)))
    odd = [(900, None, None, None), (901, "", "en", "s"), (902, LONG, "en", "s"), (None, "you vexor", "en", "s"), (3, rows[3][1], "en", "s")]
    docs = made(spark, rows + odd, extra=True)
    marks = spark.createDataFrame(labels + [(901, 1, None), (None, 1, 1), (8, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, marks, rounds=5, depth=3).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
    truth = {i: t for i, _, t in labels}
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert held and np.mean([x.predicted == truth[x.doc_id] for x in held]) > 0.97
    none = toxicity.toxicity(docs, marks.where("toxic = 0")).collect()
    assert {x.score for x in none} == {0.0} and toxicity.toxicity(docs.limit(0), marks, rounds=2).count() == 0


def test_thinned_labels_keep_their_base_rate(spark):
    # Texts tell nothing about the label, so scores have to be near the share of label 1.
    docs = made(spark, [(k, prose(k, 12), "en", "s") for k in range(3000)])
    marks = spark.createDataFrame([(k, int(random.Random(k).random() < 0.1)) for k in range(3000)], "doc_id long, toxic int")
    known = toxicity.labelled_rows(docs, marks, most=400).groupBy("label").agg({"stands_for": "sum", "label": "count"}).collect()
    kept, stands = {r.label: r["count(label)"] for r in known}, {r.label: r["sum(stands_for)"] for r in known}
    assert kept[0] < 260 and kept[1] > 150 and 0.08 < stands[1] / (stands[0] + stands[1]) < 0.13
    got = toxicity.toxicity(docs, marks, rounds=5, depth=2, most=400).collect()
    assert 0.04 < np.mean([x.score for x in got]) < 0.2 and np.mean([x.predicted for x in got]) < 0.1


def test_repeated_training_ids_are_learnt_from_once(spark):
    docs = made(spark, [(k, prose(k, 12), "en", "s") for k in range(60)] + [(1, f"again {k}", "en", "s") for k in range(300)])
    marks = spark.createDataFrame([(k, k % 2) for k in range(60)] * 2, "doc_id long, toxic int")
    known = toxicity.labelled_rows(docs, marks)
    ids = [r.doc_id for r in known.collect()]
    assert len(ids) == len(set(ids)) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(60))
    assert 1 in ids and known.where("doc_id = 1").first().text == min([prose(1, 12)] + [f"again {k}" for k in range(300)])
    assert toxicity.toxicity(docs, marks, rounds=2, depth=2).count() == 360


def test_text_features_by_hand():
    data, ends = tasks.string_bytes(pa.array(["idiot"]))
    term = tasks.word_hashes(data, ends, toxicity._LETTERS)[0]
    found = toxicity.text_features(pa.array(["You IDIOT!", "id10t here", None, "", "nice words"]), term, np.array([3.0]))
    assert found["density"].tolist() == [0.5, 0, 0, 0, 0] and found["strongest"].tolist() == [3, 0, 0, 0, 0]
    assert found["near_second_person"][0] == 0.5 and found["disguised_hits"].tolist() == [0, 1, 0, 0, 0]
    assert found["shouted"][0] > 0 and found["exclamations"][0] == 0.1


# Sharding


def test_shards_are_even_and_gapless(spark):
    rows = [(k, prose(k, 5 + k % 60), "en", "s") for k in range(800)] + [(2000 + k, "hot text " * 20, "en", "s") for k in range(400)] + odd_rows()[12:]
    rows = [r for r in rows if r[1] is None or len(r[1]) < 5000] + [(5, rows[5][1], "en", "s")]
    docs = made(spark, rows, extra=True)
    got = sharding.shard_records(docs, shards=8).collect()
    assert len(got) == len(rows)
    size = Counter()
    slots = {}
    for x in got:
        text = x.row.text or ""
        assert x["size"] == len(text.encode()) + 16 and x.text_crc32 == zlib.crc32(text.encode())
        size[x.shard] += x["size"]
        slots.setdefault(x.shard, []).append(x.slot)
    assert set(size) == set(range(8)) and max(size.values()) < 1.1 * min(size.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    place = lambda found: sorted((x.doc_id, x.shard, x.slot) for x in found if x.doc_id not in (None, 5))
    assert place(got) == place(sharding.shard_records(docs.repartition(3), shards=8).collect())
    numbered = sharding.numbered_records(docs, 8)
    assert set(numbered.columns) == set(docs.columns) and numbered.count() == len(rows)
    assert sharding.shard_records(made(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [None, 7])
def test_equal_texts_of_one_id_spread(spark, hot):
    # Copies that neither their texts nor their ids tell apart, and the law by brute force over the result.
    rows = [(hot, "hot text " * 50, "en", "s") for _ in range(1000)] + [(k + 100, prose(k, 12), "en", "s") for k in range(500)]
    got = sharding.shard_records(made(spark, rows), shards=8).collect()
    size, slots = Counter(), {}
    for x in got:
        size[x.shard] += x["size"]
        slots.setdefault(x.shard, []).append(x.slot)
    assert sum(size.values()) == sum(len(t.encode()) + 16 for _, t, _, _ in rows)
    assert len(size) == 8 and max(size.values()) <= 1.1 * min(size.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert Counter((x.doc_id, x.text_crc32) for x in got) == Counter((i, zlib.crc32(t.encode())) for i, t, _, _ in rows)


def test_written_shards_hold_their_rows_in_order(spark, tmp_path):
    docs = made(spark, [(k, prose(k, 9), "en", "s") for k in range(90)]).selectExpr("*", "1 as _shard", "2 as _SLOT")
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.shard_records(docs, shards=4), path, shards=4)
    back = spark.read.parquet(path).collect()
    want = {(x.doc_id, x.shard, x.slot) for x in sharding.shard_records(docs, shards=4).collect()}
    assert {(x.doc_id, x["_shard_"], x["_slot_"]) for x in back} == want and {x["_shard"] for x in back} == {1}
    # A folder holds one file, so a shard has one writer.
    folders = [f for f in os.listdir(path) if f.startswith("_shard_=")]
    assert len(folders) == len({x[1] for x in want}) and all(sum(n.endswith(".parquet") for n in os.listdir(f"{path}/{f}")) == 1 for f in folders)


# Helpers, pipeline and registration


def test_words_and_hashes():
    texts = ["a b\tab", None, "", "  x  ", "é ß", "y" * 700]
    data, ends = tasks.string_bytes(pa.array(texts))
    hashes, at = tasks.word_hashes(data, ends)
    assert np.diff(at).tolist() == [3, 0, 0, 1, 2, 1] and len(set(hashes.tolist())) == 7
    sliced = pa.array(["zz"] + texts)[1:]
    data, ends = tasks.string_bytes(sliced)
    assert tasks.word_hashes(data, ends)[0].tolist() == hashes.tolist()


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    leak = prose(500, 40)
    rows = [r for r in odd_rows() if r[0] is not None and r[0] < 50] + [(k, prose(k, 80), "en", f"s{k % 3}") for k in range(60, 120)] + [(200, leak + " x", "en", "s0"), (201, "1234 !", "en", "s0")]
    made(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, left = spark.read.parquet(str(tmp_path / "documents.parquet")), None
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != "sharding":
            assert docs.columns == before.columns
        left = {r.doc_id for r in docs.collect()}
        if name == "language_id":
            assert left == {r[0] for r in rows} - {20, 21, 22, 201}
        if name == "minhash_near_dedup":
            want = brute_near([r[:2] for r in rows if r[0] in {x.doc_id for x in before.collect()}], 5, 80)
            assert left == {i for i, (_, _, kept) in want.items() if kept}
        if name == "decontamination":
            assert left == {r.doc_id for r in before.collect()} - {200}
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in whole) == sorted((r.doc_id, r.shard, r.slot) for r in docs.collect())


def test_queries_match_their_oracles(spark):
    import duckdb
    from check import compare, connect

    from laurel.llm import queries

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    con = connect(folder)
    for name in ("op4_mixing", "op6_warc"):
        assert compare(queries.queries()[name](spark, folder), con, queries.oracle_sql()[name]) is None, name
    assert isinstance(con, duckdb.DuckDBPyConnection)
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{k}" for k in range(1, 14)}
