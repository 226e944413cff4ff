"""The operators of the llm subpackage, against brute force on small fixtures."""

import random
import re
import time
import unicodedata
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagelens.llm import cross_split as cross
from pagelens.llm import queries as Q
from pagelens.llm.confusables import consistent, look_alike_classes, look_alike_pairs, look_digests, token_kind
from pagelens.llm.cross_split import LetterPairs, cross_split_pairs, difference, edit_distance, overlap_report, shared_letter_pairs
from pagelens.llm.encode import WINDOW, cuts, encode_corpus, gear_table, rolling_hash
from pagelens.llm.leakage import PASSAGE, leaked_items, words
from pagelens.llm.residue import residue_documents, without_residue
from pagelens.llm.splits import assign_splits, choose, components, split_families

VOCABULARY = f"{Q.TOKENIZERS}/byte_bpe_50k.tiktoken"
tokens = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no public tokenizers")
PAGE = "page_id bigint, file_name string, image struct<path:string,src:string>, source string, split string, writer_ref string, regions array<struct<text:string>>, family string, side int, class string"
WORDS = "вода школа зошит лист двір книга перо сніг літо зима поле гора дощ птах риба хата млин стіл вікно двері стежка берег озеро човен вечір ранок голос слово рядок сторінка".split()


# Encoding.


def reference_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


@tokens
def test_ids_equal_the_tokenizers(spark):
    rng = random.Random(1)
    hard = ["", None, " ", "\n\n a", "___" * 3000, "а" * 5000, "　x" * 900, "漢字" * 3000, "<|endoftext|> x", "😀" * 2000 + " x", "it's we'LL  \r\n\tq", "no" * 4000, "a b  c"]
    hard += ["".join(rng.choice("abc '0їґ_漢\n ") for _ in range(rng.randrange(4000))) for _ in range(20)]
    rows = [(i, s, 9, "x") for i, s in enumerate(hard)] + [(None, "null id", 9, "x"), (3, hard[3], 9, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, chunk string")
    encode = reference_ids()
    got = encode_corpus(df, VOCABULARY).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in got) == sorted((i is None, i or 0, encode(s)) for i, s, _, _ in rows)
    assert encode_corpus(df.limit(0), VOCABULARY).count() == 0


def test_cuts_depend_on_content_only():
    import numpy as np

    text = " ".join(random.Random(2).choices(WORDS, k=4000)).encode()
    alone, a, b = cuts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    moved, _, _ = cuts(np.frombuffer(b"other start " + text, np.uint8), np.array([0, len(text) + 12]))
    assert set((alone[1:] + 12).tolist()) <= set(moved.tolist())
    assert 200 < len(text) / len(alone) < 1000 and len(a) > len(alone) / 2  # most cuts fall into words
    assert (a[1:] >= b[:-1]).all() and (a < b).all()


def test_rolling_hash_is_of_the_last_bytes():
    import numpy as np

    buf = np.frombuffer(random.Random(3).randbytes(300), np.uint8)
    gear = gear_table()
    for i in range(len(buf)):
        want = sum(int(gear[x]) << k for k, x in enumerate(buf[max(0, i - WINDOW) : i][::-1])) & 0xFFFFFFFF
        assert rolling_hash(buf)[i] == want


# Confusables.


def test_consistent_form():
    same = [("Вода", "Boдa"), ("сor", "cor"), ("ABC x", "ＡＢＣ　x"), ("й", "й"), ("ї", "ï"), ("а б", "а б"), ("слово", "сло​во­"), ("Ο", "O"), ("Ο", "О"), (" а", "а"), ("é", "é")]
    for a, b in same:
        assert consistent(a) == consistent(b), (a, b)
    different = [("а", "а́"), ("х²", "х2"), ("№", "No"), ("А", "а"), ("и", "й"), ("а  б", "а б"), ("З", "3"), ("👩‍🏫", "👩🏫"), ("ﬁ", "f"), ("a-b", "a–b")]
    for a, b in different:
        assert consistent(a) != consistent(b), (a, b)
    assert consistent(None) is None and consistent("") == "" and consistent("​ 　") == ""
    assert (token_kind("водa"), token_kind("сор"), token_kind("вода"), token_kind("dog")) == ("mixed", "whole", "single", "single")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aаcсoоοxBВΒHНйиїіĭ̈́  ​Дz１²№-", max_size=12))
def test_consistent_form_is_stable(t):
    once = consistent(t)
    assert consistent(once) == once
    assert consistent(unicodedata.normalize("NFD", t)) == once and consistent(t.replace(" ", " ") + "‍") == once


def test_look_alike_pairs(spark):
    texts = ["вода", "вoда", "вода", "вoдa", "Вода", None, "", "  ", "　", "x", "х", "х́"]
    rows = [(i, t, "2024-01-01", "k", b"1") for i, t in enumerate(texts)] + [(1, "інше", "2023-01-01", "k", b"1"), (None, "вода", "2024-01-01", "k", b"1"), (9, "x", None, "k", b"1")]
    df = spark.createDataFrame(rows, "region_key bigint, text string, exported_at string, k string, look binary")
    d = look_digests(df, "region_key", "text", "exported_at")
    got = {(r.a, r.b) for r in look_alike_pairs(d).collect()}
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if consistent(texts[i]) and consistent(texts[i]) == consistent(texts[j]) and texts[i] != texts[j]}
    assert got == want == {(0, 1), (0, 3), (1, 2), (1, 3), (2, 3), (9, 10)}
    classes = {r.k: (r.class_id, r.links) for r in look_alike_classes(d).collect()}
    assert classes[0] == (0, 2) and classes[1] == (0, 3) and classes[4] == (4, 0) and 5 not in classes
    assert look_alike_pairs(look_digests(df.limit(0), "region_key", "text")).count() == 0


# Families and splits.


def brute_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {v: find(v) for v in parent}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(f"{rng.randrange(60):02d}", f"{rng.randrange(60):02d}") for _ in range(50)] + [(None, "x"), ("z", "z")] * 2
    if seed == 2:  # a long path
        edges += [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(70)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == brute_components(edges)


def pages_of(spark, rows):
    return spark.createDataFrame([(i, n, (None, src), s, split, w, [(t,) for t in texts] if texts is not None else None, "f", 1, "c") for i, n, src, s, split, w, texts in rows], PAGE)


def test_split_families(spark):
    rows = [
        (1, "a/nb_007 (1).jpg", None, "s", "train", None, None), (2, "NB%2D7%5Fp2.jpg", None, "s", "val", None, None),
        (3, "nb7.jpg", None, "other", "test", None, None),
        (4, None, "x/nb-8.p1.tif", "", "silver", "W-0012", None), (5, "", None, None, "train", "w12", None), (6, "nb8_p3", None, None, "test", None, None),
        (7, "IMG_1.jpg", None, "s", "val", None, None), (8, "IMG_1.jpg", None, "s", "train", None, None),
        (9, "nb9.jpg", None, "s", "train", "W 3", None), (9, "nb9.jpg", None, "s", "train", "W 3", None), (10, "nb10.jpg", None, "s", "silver", "w0003", None),
        (None, "nb7.jpg", None, "s", "test", None, None), (11, "nb11.jpg", None, "s", "odd", "w5", None), (12, None, None, "s", "val", "w5", None),
    ]
    df = pages_of(spark, rows)
    assert sorted(r.page_id for r in split_families(df).collect()) == [1, 2, 4, 5, 6]
    assert split_families(df.limit(0)).count() == 0


def test_choose_is_exact():
    rng = random.Random(4)
    cases = [({19: 4, 24: 4, 5: 1}, 53, 0.3), ({}, 3, 0.5), ({7: 2}, 0, 0.0), ({5: 3}, 7, 1.0), ({5: 3}, 8, 0.1)]
    for _ in range(400):
        counts = {s: rng.randrange(1, 6) for s in rng.sample(range(1, 30), rng.randrange(1, 6))}
        share = rng.random()
        cases.append((counts, round(sum(s * n for s, n in counts.items()) * share), share))
    for counts, target, share in cases:
        taken = choose(counts, target, share)
        assert all(0 <= taken[s] <= counts[s] for s in counts)
        sums = {0}
        for s, n in counts.items():
            sums = {x + s * k for x in sums for k in range(n + 1)}
        assert abs(sum(s * k for s, k in taken.items()) - target) == min(abs(x - target) for x in sums)


def test_assign_splits(spark):
    rng = random.Random(6)
    rows = [(i, f"nb{rng.randrange(60)}_p{i}.jpg", None, "s", "train", f"w{rng.randrange(40)}" if i % 3 == 0 else None, None) for i in range(300)]
    rows += [(1000 + i, "scan.jpg", None, "s", "train", None, None) for i in range(200)]
    df = pages_of(spark, rows + rows[:20])
    got = assign_splits(df, {"train": 0.8, "val": 0.1, "test": 0.1}).collect()
    assert len(got) == 500 and len({r.page_id for r in got}) == 500
    by_family = defaultdict(set)
    for r in got:
        by_family[r.family].add(r.split)
    assert max(map(len, by_family.values())) == 1
    n = Counter(r.split for r in got)
    assert (n["val"], n["test"]) == (50, 50)
    assert assign_splits(df.limit(0), {"train": 1.0, "val": 0.0}).count() == 0


# Same pages across splits.


def test_edit_distance_and_difference():
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(1)
    for _ in range(2000):
        a, b = ("".join(rng.choice("абв") for _ in range(rng.randrange(9))) for _ in range(2))
        assert edit_distance(a, b) == slow(a, b)
    assert difference(["a", "bb"], ["bb", "a"]) == 0.0 and difference(["ab"], ["ac"]) == 0.5 and difference(["ab"], []) == 1.0


def noisy(rng, text, part):
    return "".join(rng.choice("абвгд") if c != " " and rng.random() < part else c for c in text)


def test_cross_split_pairs(spark):
    rng = random.Random(3)
    line = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "а", "ом", "ею", "ів"]) for _ in range(n))
    texts = {i: [line(6) for _ in range(8)] for i in range(40)}
    rows = [(i, f"t{i}.jpg", None, "s", "train" if i % 2 else "silver", None, texts[i]) for i in range(40)]
    want = set()
    for k, i in enumerate(range(0, 20)):  # near copies, shuffled and cut otherwise
        t = noisy(rng, " ".join(rng.sample(texts[i], 8)), 0.06).split(" ")
        cut = [" ".join(t[a : a + 5]) for a in range(0, len(t), 5)]
        rows.append((100 + k, f"e{k}.jpg", None, "s", "val", None, [c.upper() + "!" for c in cut]))
        want.add((i, 100 + k))
    for k, i in enumerate(range(20, 30)):  # share less than half
        rows.append((200 + k, f"d{k}.jpg", None, "s", "test", None, texts[i][:3] + [line(6) for _ in range(5)]))
    rows += [(300, "folder/t5.jpg", None, "s", "test", None, []), (301, None, "up/t6.jpg", "", "val", None, None), (302, None, None, None, "val", None, [None, "", " - "]), (303, "", None, None, "train", None, [])]
    want |= {(5, 300), (6, 301)}
    rows += [(310, "x1", None, "s", "train", None, ["коротко"]), (311, "x2", None, "s", "val", None, ["Коротко."]), (312, "x3", None, "s", "odd", None, ["коротко"]), (None, "x4", None, "s", "val", None, ["коротко"])]
    want |= {(310, 311)}
    rows += [rows[0], rows[45]]
    df = pages_of(spark, rows)
    assert {tuple(r) for r in cross_split_pairs(df).collect()} == want
    report = {(r.split, r.source): (r.n_pages, r.n_pairs) for r in overlap_report(df).collect()}
    assert report[("test", "s")] == (1, 1) and report[("val", "unknown")] == (1, 1) and report[("val", "s")] == (21, 21)
    assert cross_split_pairs(df.limit(0)).count() == 0


def test_copies_are_one_class(spark):
    text = [" ".join(WORDS[:12]), " ".join(WORDS[12:24])]
    rows = [(i, f"a{i}", None, "s", "train" if i < 30 else "test", None, text) for i in range(40)]
    assert cross_split_pairs(pages_of(spark, rows)).count() == 300
    # The same words: regions in another order and cut otherwise are the same page, words in another order aren't.
    whole = " ".join(text)
    rows = [(1, "a", None, "s", "train", None, text), (2, "b", None, "s", "val", None, text[::-1]), (3, "c", None, "s", "val", None, [whole[:40], whole[40:]] if whole[40] == " " else [whole]), (4, "d", None, "s", "test", None, [" ".join(whole.split()[::-1])])]
    assert {tuple(r) for r in cross_split_pairs(pages_of(spark, rows)).collect()} == {(1, 2), (1, 3)}


def test_repeated_words():
    rng = random.Random(9)
    for _ in range(50):
        once = [rng.choice(WORDS) for _ in range(20)]
        a = once * 2  # no word occurs once
        b = [*a]
        b[3] = "ж" + b[3][1:]
        assert difference(a, a) == 0.0 and difference(a, b) <= 1 / len("".join(a))
        assert difference(a, [rng.choice(WORDS)[::-1] for _ in a]) > 0.4


def test_lost_spaces():
    rng = random.Random(10)
    for _ in range(30):
        lines = [[rng.choice(WORDS) + rng.choice(["", "ом", "ею"]) for _ in range(8)] for _ in range(6)]
        a = sum(lines, [])
        joined = [[*t[:2], t[2] + t[3], t[4] + t[5], t[6] + t[7]] for t in lines]
        assert difference(a, sum(joined, [])) == 0.0
        assert difference(a, sum(joined[::-1], [])) < 0.3 and difference(sum(joined[::-1], []), a) < 0.3
        assert difference(a, noisy(rng, " ".join(sum(lines[::-1], [])), 0.2).split()) < 0.3
        assert difference(a, a[::-1]) > 0.4


def test_changes_in_all_words(spark):
    rng = random.Random(11)
    rows, want = [], set()
    for i in range(20):  # each fifth letter is changed, so hardly a word is left
        lines = ["".join(rng.choice("абвгдежзиклмнопрст") for _ in range(35)) for _ in range(8)]
        lines = [" ".join(t[k : k + 7] for k in range(0, 35, 7)) for t in lines]
        rows.append((i, f"t{i}", None, "s", "train", None, lines))
        letters = iter(range(9999))
        changed = ["".join(c if c == " " or next(letters) % 5 else "ю" for c in t) for t in lines]
        rows.append((100 + i, f"e{i}", None, "s", "val", None, rng.sample(changed, 8)))
        want.add((i, 100 + i))
    assert {tuple(r) for r in cross_split_pairs(pages_of(spark, rows)).collect()} == want


def test_all_pairs_within_a_fifth_are_found(spark):
    rng = random.Random(13)
    voc = ["".join(rng.choice("абвгдежзиклмнопрст") for _ in range(rng.randrange(2, 10))) for _ in range(2000)]
    text = lambda n: " ".join(rng.choices(voc, [1 / (i + 1) for i in range(2000)], k=n))
    rows, want = [], set()
    for k in range(60):
        n, part = rng.choice((8, 60)), rng.choice((0.1, 0.19))
        t = text(n)
        c = "".join(rng.choice("абвгдежзиклмнопрст") if x != " " and rng.random() < part else x for x in t)
        rows += [(2 * k, f"a{k}", None, "s", "train", None, [t]), (2 * k + 1, f"b{k}", None, "s", "test", None, [c])]
        a, b = t.replace(" ", ""), c.replace(" ", "")
        if 5 * edit_distance(a, b) <= max(len(a), len(b)):
            want.add((2 * k, 2 * k + 1))
    rows += [(1000 + k, f"o{k}", None, "s", rng.choice(("train", "val")), None, [text(rng.choice((8, 60)))]) for k in range(300)]
    got = {tuple(r) for r in cross_split_pairs(pages_of(spark, rows)).collect()}
    assert want <= got and all(b == a + 1 for a, b in got) and len(want) > 30


def test_shared_letter_pairs():
    rng = random.Random(12)
    a, b = (["".join(rng.choice("абв") for _ in range(rng.randrange(1, 40))) for _ in range(30)] for _ in range(2))
    count = lambda t: Counter(zip(t, t[1:]))
    assert shared_letter_pairs(LetterPairs(a), LetterPairs(b)).tolist() == [[(count(x) & count(y)).total() for y in b] for x in a]


def test_shared_prefixes():
    rng = random.Random(14)
    voc = ["".join(rng.choice("абв") for _ in range(rng.randrange(1, 4))) for _ in range(30)]
    a, b = ([" ".join(rng.choices(voc, k=rng.choice((1, 2, 5, 12, 13, 40)))) for _ in range(60)] for _ in range(2))

    def shingles(t):
        w = t.split(" ")
        return {*zip(w, w[1:]), *([(x,) for x in w] if len(w) <= cross.SHORT else [])}

    sa, sb = cross.Shingles(a), cross.Shingles(b)
    common = [[len(shingles(x) & shingles(y)) for y in b] for x in a]
    assert cross.shared_kinds(sa, sb).tolist() == common
    got = cross.shared_prefixes(sa, sb)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            assert got[i, j] <= common[i][j]
            if common[i][j] >= cross.RETRIEVE * max(len(shingles(x)), len(shingles(y))):
                assert got[i, j] >= min(sa.need[i], sb.need[j])


def test_disk_of_blocks_is_in_proportion(spark, monkeypatch):
    """What is shuffled grows with the texts, not with the pairs of blocks, and tables too large for a broadcast give the same."""
    monkeypatch.setattr(cross, "BLOCK", 1000)
    rng = random.Random(15)
    voc = ["".join(rng.choice("абвгдежзиклмнопрст") for _ in range(rng.randrange(4, 8))) for _ in range(3000)]
    context = spark.sparkContext._jsc.sc()

    def written():
        context.listenerBus().waitUntilEmpty()
        time.sleep(0.3)
        spark.range(1).count()
        context.listenerBus().waitUntilEmpty()
        return context.statusStore().executorSummary("driver").totalShuffleWrite()

    def shuffled(n):
        rows = []
        for i in range(n):
            t = rng.choices(voc, k=40)
            rows += [(2 * i, f"a{i}", None, "s", "train", None, [" ".join(t)]), (2 * i + 1, f"b{i}", None, "s", "val", None, [" ".join([*t[:20], *rng.choices(voc, k=2), *t[22:]])])]
        before = written()
        assert {tuple(r) for r in cross_split_pairs(pages_of(spark, rows)).collect()} == {(2 * i, 2 * i + 1) for i in range(n)}
        return written() - before

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffled(320) < 4.5 * shuffled(80)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_each_word_order_is_compared(spark):
    rng = random.Random(8)
    a = [w + e for w in WORDS[:24] for e in ("", "ом")]
    scrambled, b = rng.sample(a, len(a)), [*a[:-1], "інше"]
    for ids in ((2, 1), (1, 2)):  # page A and the scrambled page; B is a near copy of A alone
        rows = [(i, f"a{i}", None, "s", "train", None, [" ".join(t)]) for i, t in zip(ids, (a, scrambled))]
        rows += [(3, "b", None, "s", "val", None, [" ".join(b)])]
        assert {tuple(r) for r in cross_split_pairs(pages_of(spark, rows)).collect()} == {(ids[0], 3)}


# Leakage.


def test_words():
    assert words("Вапє-\n> желя, I'd’ve AB-864 е́ ¼") == words("вапєжеля Idve ab864 е ¼")
    assert words("Boда​") == words("вода") and words("BOX") == words("box") and words("") == []
    assert words("a\r\n| b") == ["a", "b"]


def test_leaked_items(spark):
    rng = random.Random(8)
    item = lambda n: [rng.choice(WORDS) + rng.choice("аоуиіею") + rng.choice("мнрст") for _ in range(n)]
    items = {i: item(40) for i in range(12)} | {50: item(5)}
    filler = lambda: item(rng.randrange(20, 60))
    docs, want = [], set()

    def add(words_, *of):
        docs.append((len(docs), " ".join(filler() + words_ + filler())))
        want.update((docs[-1][0], i) for i in of)

    for i in range(12):
        add(items[i], i)
        add(items[i][7:19], i)
        add(items[i][3:9])  # six words only
        add(rng.sample(items[i], 40))  # another order
        slip = list(items[i][5:23])
        slip[4], slip[13] = "xx" + slip[4], slip[13][:-1]
        add(slip, i)
        t = " ".join(items[i][:20])
        cut = t[: len(t) // 2 - 3] + "-\n> " + t[len(t) // 2 - 3 :] if t[len(t) // 2 - 4].isalpha() and t[len(t) // 2 - 3].isalpha() else t
        docs.append((len(docs), cut.upper().replace("О", "O") + "."))
        want.add((docs[-1][0], i))
    add(items[50], 50)
    add(items[50][:4])
    add(items[0] + filler() + items[1], 0, 1)
    docs += [(900, None), (901, ""), (902, "   "), (None, " ".join(items[0])), (0, docs[0][1])]
    d = spark.createDataFrame([(i, t, 1, [1]) for i, t in docs], "doc_id bigint, text string, item_id int, terms array<int>")
    e = spark.createDataFrame([(i, " ".join(t), 5) for i, t in items.items()] + [(60, None, 5), (61, "", 5), (None, "x", 5), (0, " ".join(items[0]), 5)], "item_id bigint, text string, doc_id int")
    assert {tuple(r) for r in leaked_items(d, e).collect()} == want
    assert leaked_items(d.limit(0), e).count() == 0 and leaked_items(d, e.limit(0)).count() == 0
    assert PASSAGE == 12


def test_lists_are_expanded_in_parts(monkeypatch):
    import numpy as np

    from pagelens.llm import leakage

    rng = random.Random(5)
    line = np.array([rng.randrange(4) for _ in range(400)] + [-1])
    at = np.argsort(line[:-1], kind="stable")
    row = {"starts": np.array([0, 401]), "terms": np.arange(4), "positions": at, "ends": np.cumsum(np.bincount(line[:-1]))}
    query = leakage.Query([(7, line[100:130].tolist()), (8, [3, 0, 1] * 5)], {0: 5, 1: 6, 2: 7, 3: 8})
    whole = list(leakage.passages(query, row))
    monkeypatch.setattr(leakage, "EXPANDED", 3)
    assert list(leakage.passages(query, row)) == whole and (0, 0, 12) in whole


def test_many_rounds_of_items(spark, monkeypatch):
    from pagelens.llm import leakage

    monkeypatch.setattr(leakage, "ROUND_WORDS", 15)
    d = spark.createDataFrame([(1, " ".join(WORDS))], "doc_id bigint, text string")
    e = spark.createDataFrame([(i, " ".join(WORDS[i : i + 12])) for i in range(6)], "item_id bigint, text string")
    assert sorted(r.item_id for r in leaked_items(d, e).collect()) == list(range(6))


# Residue.

RESIDUE = [
    "Lorem ipsum dolor sit amet elit.", "Текст\n\n404 Not Found\nRequest id: 3dceae775a21\n\nтекст", "Please enable java script to view this page.", "Ваш браузер не підтримує скрипти у налаштуваннях.",
    "Тут буде текст. Тут буде текст.", "Вода {{ автор | upper }} тече", "Вода ${scan_date} тече", "a <%= file.count %> b", "[[НАЗВА]]", "@@grade@@", "%%PAGE_TITLE%%", "__АВТОР__", "Title: %(shelf_mark)s",
    "{% block grade %}{% endblock %}", "[INSERT SCAN DATE]", "[тут вкажіть автор]", "<вставити: subject>", "<your fund name here>", "коли TODO: дата тут", "Error 403: You have no access to this folder", "HTTP 502 — Помилка шлюзу",
    "Something went wrong. Please try again.", "You don't have permission to access this resource.", "JavaScript must be enabled", "Під час обробки запиту сталася помилка.", "Dear [Company Name]", "Title: [Date]",
    "обкладинка аркуш справа Please enable JavaScript to view this page а далі опис фонду і перелік аркушів", "menu list of funds 404 Not Found back to shelf and the list of all years",
    "Вода {{ автор }} тече. Помилка 503 траплялася тричі.",
    "asdf qwer йцук xxx тест", "Хліб · Вода\nВключите JS.\n© 2017", "Тут бу​де тeкст.",
]
CONTENT = [
    "Слово «lorem» у прописах узято як зразок шрифту.", "Помилка 503 траплялася тричі, доки ми переносили скани.", "У рядку 404 книги обліку стоїть ціна.", "На уроці пояснили, що таке JavaScript і навіщо він сторінкам.",
    "Опис полів шаблону: `{{назва}}` замінюється назвою, а `${author}` числом.", r"Формула \mathbf{{x}} + {{y}}_{2} переписана з дошки.", r"In LaTeX we write \frac{{a}}{{b}} with both braces.", "Мітка «{{дата}}» стоїть у картці.",
    "The template uses {{ name }} as a field, as the guide explains.", "У полі шаблону {{дата}} пишуть число.", 'We once read "Please enable JavaScript to view this page" on the old site and laughed.',
    "The message 404 Not Found means that the shelf has no such folder in it.", "[sic] [нрзб] [Kyiv]",
    "____________", "[закреслено] ~~a~~{b} [нрзб] (?)", "", None, "   ", "21.05.2005", "A row of lorem ipsum was once printed to test the font.", "404", "y = 12x^{2} - 3x + 7", "Turn on.",
]


def test_residue(spark):
    texts = RESIDUE + CONTENT
    rng = random.Random(1)
    rows = [(i, t, "p", 3) for i, t in enumerate(texts)] + [(1000 + i, " ".join(rng.choices(WORDS, k=30)), "p", 3) for i in range(200)] + [(0, RESIDUE[0], "p", 3), (None, RESIDUE[0], "p", 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, passage string, n int")
    got = sorted(r.doc_id for r in residue_documents(df).collect())
    assert [texts[i] for i in got] == RESIDUE
    assert without_residue(df).count() == len(rows) - len(RESIDUE) - 1
    assert residue_documents(df.limit(0)).count() == 0


# Registered queries.

SF = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_queries_run(spark, name):
    df = Q.queries()[name](spark, str(SF))
    columns = {"p2_found": ["page_id"], "p3_found": ["page_a", "page_b"], "p4_found": ["region_a", "region_b"], "p6_ids": ["doc_id", "ids"], "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id"]}
    assert df.columns == columns.get(name, df.columns) and df.count() >= 0


def test_no_text_is_cut():
    for p in Path(Q.__file__).parent.glob("*.py"):
        assert not re.search(r"\.limit\((?!1\))|\.sample\(|localCheckpoint|crossJoin", p.read_text()), p
