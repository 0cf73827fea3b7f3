"""Spelling, conversation repair, BPE, and the pipeline's stages on null and repeated ids, against brute force."""

import hashlib
import itertools
import json
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from laurel.llm import bpe, conversations, decontamination, language, minhash, spelling

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
CLASHES = "word string, n long, id long, part int, place int, ids int, kind string, node long"


def made(spark, rows):
    """(doc_id, text) rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "w", 1, 2, 3, 4, 5, "k", 6) for i, t in rows], f"doc_id long, text string, {CLASHES}")


# BPE


def merged(word, ranks, suffix="</w>"):
    """Tokens of a word by the textbook loop: merge the first pair of the lowest rank until none is left."""
    parts = [*word[:-1], word[-1] + suffix]
    while True:
        best = min(((ranks[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
        if best is None:
            return parts
        k = best[1]
        parts[k : k + 2] = ["".join(parts[k : k + 2])]


@pytest.fixture(scope="module")
def model():
    return bpe.model(PATH)


def test_prefix_tokens_equal_the_merge_loop(model):
    ranks = {tuple(p): k for k, p in enumerate(json.load(open(PATH))["model"]["merges"])}
    r = random.Random(5)
    words = ["a", "aaaaaaaaaaaaa", "abababababa", "antidisestablishmentarianism", "ththththe"]
    words += ["".join(r.choice("aehinorst") for _ in range(r.randrange(1, 25))) for _ in range(1500)]
    words += ["".join(r.choice("!#-=.") for _ in range(r.randrange(1, 30))) for _ in range(300)]
    for word in words:
        symbols = [model.vocabulary[c] for c in word[:-1]] + [model.vocabulary[word[-1] + "</w>"]]
        assert [model.tokens[i] for i in model.word_ids(symbols)] == merged(word, ranks), word


def test_bpe_equals_the_library(spark, model, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "BATCH_BYTES", 4000)
    library = Tokenizer.from_file(PATH)
    r = random.Random(7)
    odd = " aAbtheS's'll\t\n\x1c\x85\xa0ÀÉßΣςİ0129½!?.<|endoftext|>東京각́😀‍﻿K"
    texts = [None, "", " \t\n", "Hello world's", "<|endoftext|>x<|startoftext|>", "a" * 30000, "ab " * 20000, "é ́e"]
    texts += ["".join(r.choice(odd) for _ in range(r.randrange(1, 80))) for _ in range(400)]
    rows = list(enumerate(texts)) + [(None, "no id"), (3, "again"), (3, "again")]
    got = bpe.digests(bpe.decode(bpe.encode(made(spark, rows).repartition(3), PATH), PATH)).collect()
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decimal, decoded = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (decimal, decoded))))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.digests(bpe.decode(bpe.encode(made(spark, []), PATH), PATH)).count() == 0
    listed = bpe.encode(made(spark, rows[:8]), PATH).collect()
    assert all(x.n_tokens == len(x.ids) and x.ids == library.encode(rows[x.doc_id][1] or "", add_special_tokens=False).ids for x in listed)


def test_bpe_refuses_other_files():
    with pytest.raises(ValueError):
        bpe.Model(public_tokenizers.path("byte_bpe_50k.json"))


# Spelling


def brute_words(rows, least_length, least_count, one_in):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_groups(words, times):
    forms, counts = {}, {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        counts[w] = len(close)
        forms[w] = best if best is not None and words[best] >= times * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, counts[w], words[forms[w]] if forms[w] else None))
    return sorted(out, key=repr)


def test_spelling_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 50)
    r = random.Random(11)
    base = ["".join(r.choice("abcé") for _ in range(r.randrange(3, 7))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "Ñandúes", "naïveté"]
    rows = []
    for k in range(40):
        words = [base[min(int(r.expovariate(0.08)), len(base) - 1)] for _ in range(120)]
        words = [w if r.random() < 0.8 else w[: r.randrange(len(w))] + r.choice("abcé") + w[r.randrange(len(w)) :] for w in words]
        rows.append((k, " ".join(w.upper() if r.random() < 0.1 and w.isascii() else w for w in words)))
    rows += [(100, None), (101, ""), (102, "1 2 3"), (None, rows[0][1]), (5, rows[1][1]), (5, rows[1][1]), (103, "z" * 50000 + " " + "z" * 50000)]
    want = brute_words(rows, 3, 2, 7)
    docs = made(spark, rows).repartition(5)
    got = spelling.variant_words(docs, 3, 2, 7)
    assert {x.word: x.n for x in got.collect()} == want
    groups = spelling.spelling_groups(got, times=2).collect()
    short = {w: n for w, n in want.items() if len(w) < 100}
    assert sorted((tuple(x) for x in groups if len(x.word) < 100), key=repr) == brute_groups(short, 2)
    assert spelling.spelling_groups(spelling.variant_words(made(spark, []))).count() == 0


def test_trie_nodes_are_the_same_in_all_parts(spark):
    r = random.Random(2)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randrange(1, 9))) for _ in range(300)} | {"b" * k for k in range(1, 60)})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(7)
    named = spelling.node_pairs(frame)[0].collect()
    assert len({x.id for x in named}) == len(words) and [x.word for x in sorted(named, key=lambda x: x.id)] == words
    _, pairs = spelling.node_pairs(frame)
    ids = {x.id: x.word for x in named}
    prefixes, suffixes = {}, {}
    for x in pairs.collect():
        w = ids[x.id]
        places = [k for k in range(len(w) + 1)]
        assert 0 <= x.p and 0 <= x.s
        prefixes.setdefault(x.p, set()).add(w), suffixes.setdefault(x.s, set()).add(w)
        assert places
    # A node holds the words that begin (end) with one string, so as many nodes as there are beginnings (ends).
    assert len(prefixes) == len({w[:k] for w in words for k in range(len(w) + 1)})
    assert len(suffixes) == len({w[k:] for w in words for k in range(len(w) + 1)})


# Conversations


def brute_search(steps, start, ends):
    """All edit sequences with at most two insertions in a row."""
    best = None
    due, kept = (2, 2, 3, 2), ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})

    def go(k, state, cost, audit, inserted):
        nonlocal best
        if k == len(steps) and state in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if inserted < 2:
            go(k, due[state], cost + 2, audit + "I", inserted + 1)
        if k < len(steps):
            initial, forced, extra = steps[k]
            go(k + 1, state, cost + 3, audit + "D", 0)
            if not forced:
                go(k + 1, due[state], cost + 2 + extra, audit + "R", 0)
                if initial in kept[state]:
                    go(k + 1, kept[state][initial], cost + extra, audit + "K", 0)

    go(0, start, 0, "", 0)
    return best


def test_search_against_all_edits():
    for n in (0, 1, 2):
        for steps in itertools.product(itertools.product("suax", (False, True), (0, 1)), repeat=n):
            for start, end in itertools.product(range(4), range(4)):
                assert conversations.search(list(steps), start, end) == brute_search(steps, start, {end})
    r = random.Random(3)
    for _ in range(150):
        steps = [(r.choice(["s", "u", "a", "a", "u", "", "U"]), r.random() < 0.2, r.randrange(2)) for _ in range(r.randrange(3, 6))]
        start, end = r.randrange(4), r.randrange(4)
        assert conversations.search(steps, start, end) == brute_search(steps, start, {end})


def whole_repair(rows):
    """Repair of (turn, role, text) rows in one piece."""
    seen, steps, counts = set(), [], Counter()
    for _, role, text in rows:
        kind = conversations.fault(text, (role, text) in seen)
        seen.add((role, text))
        counts[kind] += 1
        steps.append((role[:1], kind in ("blank", "duplicate"), int(kind == "truncated")))
    cost, audit = min(x for x in (conversations.search(steps, 0, e) for e in (0, 3)) if x)
    text = "\n".join(f"{r}:{t}" for _, r, t in conversations.edited([x[1:] for x in rows], 0, audit))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), text


def test_repair_in_pieces(spark):
    r = random.Random(9)
    texts = ["Yes.", "No!", "Why", "", " \n", "so it goes", "Fine?  ", "x" * 5000]
    table = []
    for conv in (1, 2, 3, None, 7):
        size = {1: 400, 7: 1}.get(conv, r.randrange(5, 40))
        table += [(conv, t if r.random() < 0.95 else None, r.choice(["user", "assistant", "system", "user", "tool", ""]), r.choice(texts) + r.choice(["", " a.", " b"]) * r.randrange(2)) for t in range(size)]
    table += [(9, 4, "user", "same") for _ in range(30)] + [(10, 2**62, None, None)]
    rows = spark.createDataFrame([x + (1, "p") for x in table], "conv_id long, turn long, role string, text string, part int, piece string").repartition(6)
    want, wanted_texts = {}, {}
    for conv in {x[0] for x in table}:
        own = [(t, role if role is not None else " ", text if text is not None else " ") for c, t, role, text in table if c == conv]

        def key(x):
            name = f"{'' if conv is None else conv}:{str(conv is None).lower()}:{len(x[1])}:{x[1]}:{x[2]}"
            return (x[0] is not None, x[0] or 0, x[1][:64].encode(), x[2][:64].encode(), hashlib.md5(name.encode()).hexdigest())

        want[conv], wanted_texts[conv] = whole_repair(sorted(own, key=key))
    for piece_rows in (1, 3, 256):
        searched = conversations.searched_rows(rows, piece_rows)
        repairs = conversations.chained(searched)
        got = {x.conv_id: tuple(x)[1:-1] for x in repairs.collect()}
        assert got == want
        kept = {}
        for x in sorted(conversations.repaired_rows(searched, repairs).collect(), key=lambda x: (x.part, x.piece, x.place)):
            kept.setdefault(x.conv_id, []).append(f"{x.role}:{x.text}")
        assert {c: "\n".join(v) for c, v in kept.items()} == {c: t for c, t in wanted_texts.items() if t}
    every = spark.createDataFrame([(1,), (None,), (55,), (55,)], "conv_id long")
    found = {x.conv_id: tuple(x)[1:] for x in conversations.repair(every, rows).collect()}
    assert found[1] == want[1] and found[None] == want[None]
    assert found[55] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and len(found) == 3
    assert conversations.repair(rows.limit(0), rows.limit(0)).count() == 0


def test_long_conversation_is_searched_in_little_time():
    r = random.Random(4)
    steps = [(r.choice("uas"), r.random() < 0.15, r.randrange(2)) for _ in range(conversations.PIECE_ROWS)]
    assert all(conversations.search(steps, a, 3) for a in range(4))


def test_damage(spark):
    rows = spark.createDataFrame([(k, t, "assistant", "One. Two!") for k in range(60) for t in range(4)] + [(None, None, None, None)], "conv_id long, turn long, role string, text string")
    got = Counter(tuple(x) for x in conversations.damaged(rows).collect())
    want = Counter()
    for c, t, role, text in rows.collect():
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            want[c, t, "user" if kind == 4 else role, text] += 2 if kind == 3 else 1
    assert got == want


# Stages on null and repeated ids


def prose(seed, words):
    r = random.Random(seed)
    return " ".join(f"{r.choice('abcdefgh')}o{r.randrange(400)}" for _ in range(words))


def test_stages_judge_rows_by_their_texts(spark):
    a, b, leak = prose(1, 80), prose(2, 80), prose(3, 60)
    docs = made(spark, [(1, a), (5, a), (5, b), (None, a), (None, b + " end"), (None, leak), (7, leak + " more"), (8, None), (None, ""), (9, prose(4, 30)), (9, prose(4, 30))])
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((x.doc_id, x.text) for x in kept.collect()), key=repr) == sorted([(1, a), (5, b), (7, leak + " more"), (8, None), (None, ""), (9, prose(4, 30)), (9, prose(4, 30))], key=repr)
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    clean = decontamination.drop_leaked(docs, items)
    assert clean.columns == docs.columns and clean.count() == 9
    assert not clean.where(F.col("text").contains(leak)).count()
    known = language.keep_known_languages(docs.withColumn("lang", F.lit("en")))
    assert known.count() == 9 and not known.where("text is null or text = ''").count()
    assert minhash.drop_near_duplicates(docs.limit(0)).count() == decontamination.drop_leaked(docs.limit(0), items).count() == 0


def test_oracles_of_the_new_queries(spark):
    from check import compare, connect

    from laurel.llm import queries

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    con = connect(folder)
    for name in ("op11_spelling", "op12_conversations"):
        assert compare(queries.queries()[name](spark, folder), con, queries.oracle_sql()[name]) is None, name
