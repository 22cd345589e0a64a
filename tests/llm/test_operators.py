"""Each operator on small tables with nulls, empty and repeated rows, ties and extra columns."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickforge.llm import bpe, chat, common, decontam, fagin, gbt, langid, lmscore, mixing, neardup, pii, quality, topk, warc
from tickforge.llm.common import Scratch, rows_of, rows_without
from tickforge.llm.graph import components
from tickforge.llm.queries import TOKENIZER
from tickforge.llm.shingles import shingle_set

PATH = public_tokenizers.path(TOKENIZER)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, key int"


def docs(spark, *texts, first=0):
    """Documents with columns whose names the operators use inside, too."""
    rows = [(first + n, t, "en", "s", len(t or ""), "x", n) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(seed, n):
    random.seed(seed)
    return " ".join(random.choice("abcdefghij") + random.choice("klmnop") * 2 for _ in range(n))


# 1. BPE


@pytest.fixture(scope="module")
def automaton():
    return bpe.Automaton(**bpe.read_tokenizer(PATH))


def test_encoding_is_that_of_the_public_library(automaton):
    theirs = Tokenizer.from_file(PATH)
    random.seed(4)
    labels = [label.decode() for label in automaton.labels if label.isascii()]
    texts = ["", "a" * 3000, "It's  we'll \n\n x\t y 漢字 😀 ²Ⅷ", "a<|endoftext|>b  ", "\x1c\x1d \x85 z9_"]
    texts += ["".join(random.choices(labels, k=6)) for _ in range(2000)]
    for text in texts:
        ids = theirs.encode(text, add_special_tokens=False).ids
        packed = automaton.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, text
        assert automaton.decode(packed) == theirs.decode(ids, skip_special_tokens=False)


def test_encode_and_decode_tables(spark):
    table = docs(spark, "Hello there", None, "", "Hello there")
    rows = bpe.encode(table, PATH, decoded=True).orderBy("doc_id").collect()
    assert [r.decoded for r in rows] == ["Hello there", "", "", "Hello there"]
    assert rows[0].ids == rows[3].ids and rows[1].ids == b""
    back = bpe.decode(bpe.encode(table, PATH), PATH).orderBy("doc_id").collect()
    assert [r.text for r in back] == [r.decoded for r in rows]
    assert bpe.encode(table.limit(0), PATH).count() == 0


# 2. Near-duplicates


def shingles(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
    size = min(size, len(found))
    return {tuple(found[k : k + size]) for k in range(len(found) - size + 1)} if found else set()


def brute_components(texts, size, percent=80):
    sets = [shingles(t, size) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [(len(sets[n]), root(n)) for n in range(len(texts))]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_match_brute_force(spark, size):
    base = words(1, 120)
    texts = [None, "", "One", "one", "Two words", "two words", base, base.upper(), " \t\n"]
    random.seed(9)
    for _ in range(60):  # chains of edits: some links, many near misses
        parts = random.choice(texts[6:]).split()
        for _ in range(random.randint(0, 6)):
            if parts:
                parts[random.randrange(len(parts))] = random.choice(["xx", "yy", "zz", "ww"])
        texts.append(" ".join(parts))
    got = neardup.near_duplicates(docs(spark, *texts), words=size).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in got] == brute_components(texts, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_odd_tables(spark):
    table = docs(spark, "a b c d", "a b c d").union(docs(spark, "a b c d", "q r s t"))
    table = table.union(table.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    rows = neardup.near_duplicates(table, words=2).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in rows} == {
        (0, 0, True), (1, 0, False), (1, 1, True), (None, 0, False)
    }
    assert neardup.near_duplicates(table.limit(0)).count() == 0


def test_mixed_buckets_match_brute_force(spark):
    """Variants of one text around the threshold: buckets whose members are partly linked."""
    random.seed(8)
    base = words(5, 60).split()
    texts = []
    for _ in range(260):
        copy = list(base)
        for at in random.sample(range(60), random.choice([1, 2, 3, 4, 5, 9])):
            copy[at] = f"w{random.randrange(10**6)}"
        texts.append(" ".join(copy))
    rows = neardup.near_duplicates(docs(spark, *texts), words=2, percent=80).collect()
    roots = dict(enumerate(root for _, root in brute_components(texts, 2)))
    assert {r.doc_id: r.component_id for r in rows} == roots and len(set(roots.values())) > 20


def test_long_words_that_sums_cannot_tell_apart():
    thue = "a"
    for _ in range(11):
        thue += thue.translate(str.maketrans("ab", "ba"))
    other = thue.translate(str.maketrans("ab", "ba"))
    assert len(thue) == 2048 and shingle_set(thue, 2)[0] != shingle_set(other, 2)[0]
    assert shingle_set("x " + thue.upper(), 2)[0] == shingle_set("X " + thue, 2)[0]


def test_rows_are_found_and_left_by_filtered_ids(spark):
    table = spark.createDataFrame([(n % 100 if n < 150 else None, n) for n in range(160)], "id long, word long")
    ids = table.where("id < 30").select("id")
    with Scratch(spark, "filter") as scratch:
        assert sorted(r.word for r in rows_of(table, ids, "id", scratch).collect()) == [n for n in range(150) if n % 100 < 30]
        assert sorted(r.word for r in rows_without(table, ids, "id", scratch).collect()) == [n for n in range(160) if n % 100 >= 30 or n >= 150]
        assert rows_without(table, ids.limit(0), "id", scratch).count() == 160


def test_sketches_estimate_and_merge():
    random.seed(2)
    pool = np.random.default_rng(0).integers(0, 1 << 63, 900).astype(np.uint64)
    one, other = np.sort(pool[:600]), np.sort(pool[200:800])
    sketches = [neardup.set_sketch(s) for s in (one, other, np.union1d(one, other))]
    assert (neardup.merge_sketches(*sketches[:2]) == sketches[2]).all()
    guess = neardup.estimate(sketches[0][None], sketches[1][None], np.array([600.0]), np.array([600.0]))
    assert abs(guess[0] - 0.5) < 0.1


def test_components_of_a_chain_and_a_star(spark):
    edges = [(n, n + 1) for n in range(30)] + [(100, n) for n in range(101, 140)] + [(7, 7), (3, 2)]
    with Scratch(spark, "test") as scratch:
        table = components(spark.createDataFrame(edges, "u long, v long"), scratch)
        found = {r.node: r.component for r in table.collect()}
    assert found == {n: 0 for n in range(1, 31)} | {n: 100 for n in range(101, 140)}


# 3. Quality and boosted trees


def test_boosted_trees_learn_and_do_without_labels():
    random = np.random.default_rng(0)
    rows = random.normal(size=(2000, 5))
    labels = (rows[:, 1] > 0.3) ^ (rows[:, 3] > 0)
    model = gbt.fit(rows[:1500], labels[:1500])
    assert ((model.probability(rows[1500:]) > 0.5) == labels[1500:]).mean() > 0.93
    assert gbt.fit(np.zeros((0, 5)), []).probability(rows[:2]).tolist() == [0.5, 0.5]


def test_quality_learns_from_rows_that_are_not_held_out(spark):
    texts = [words(n, 60) if n % 2 else "### $$$ " * 40 + words(n, 9) for n in range(240)]
    table = docs(spark, *texts, None, "")
    known = [(n, n % 2, 0) for n in range(240)] + [(3, None, 0), (5, 7, 0), (None, 1, 0)]
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(table, labels).orderBy("doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 240]
    assert all((r.score > 0.5) == bool(r.doc_id % 2) for r in held)
    # A held-out label has no influence.
    flip = F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality"))
    other = labels.withColumn("quality", F.coalesce(flip, "quality"))
    assert quality.quality_scores(table, other).orderBy("doc_id").collect() == rows
    alone = quality.quality_scores(table, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in alone] == [0.5]


# 4. Decontamination

ITEM = "a train leaves the old station with Tom and 40 people while the other 12 people stay behind"


def test_template_matches_need_consistent_slots(spark):
    other = ITEM.replace("40", "55").replace("12", "9").replace("Tom", "Ann")
    items = spark.createDataFrame([(1, ITEM + " near 40 km"), (2, None), (3, "too short")], "item_id long, text string")
    texts = [f"see {ITEM} near 40 km here", f"see {other} near 55 km here", f"see {other} near 77 km here", None, "", words(3, 200)]
    table = docs(spark, *texts)
    rows = decontam.contaminated(table.union(table.limit(1)), items).orderBy("doc_id").collect()
    # Document 2 maps the item's 40 to 55 and to 77.
    assert [(r.doc_id, r.item_id, r.exact) for r in rows] == [(0, 1, True), (1, 1, False)]
    assert decontam.contaminated(table.limit(0), items).count() == 0
    assert decontam.contaminated(table, items.limit(0)).count() == 0


def brute_contaminated(texts, items):
    """The definition, pair by pair and offset by offset."""

    def coded(text, plain=False):
        found = []
        for word in (text or "").split():
            code = decontam.canonical(word)
            value = decontam._EDGE.sub("", word).lower()
            if code:
                found.append((decontam._hash(value) if plain and code == decontam.NAME else code, value))
        return found

    rows = set()
    for i, item in items.items():
        forms = [coded(item), coded(item, plain=True)]
        size = min(8, len(forms[0]))
        if not size:
            continue
        starts = range(len(forms[0]) - size + 1)
        rich = [k for k in starts if sum(c >= 16 for c, _ in forms[0][k : k + size]) >= 4]
        for d, text in texts.items():
            words = coded(text)
            for offset in range(-len(forms[0]), len(words)):
                windows, pairs = set(), set()
                for k in rich or starts:
                    there = words[offset + k : offset + k + size] if offset + k >= 0 else []
                    for form in forms:
                        if [c for c, _ in there] == [c for c, _ in form[k : k + size]]:
                            windows.add(k)
                            pairs |= {(a, b) for (c, a), (_, b) in zip(form[k : k + size], there) if c < 16}
                one_to_one = len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
                exact = all(a == b for a, b in pairs)
                if windows and one_to_one and (rich or exact) and len(windows) >= min(3, len(rich or starts)):
                    rows.add((d, i))
    return rows


def test_contamination_matches_the_definition(spark):
    random.seed(12)
    items = {
        1: ITEM, 2: "what is seven plus five minus two", 3: "Ada met Bob and Cid in Rome near 3 lakes on day 9 of May",
        4: "12 13 14 15 16 17 18 19 20", 5: "hello", 6: None, 7: "", 8: "... !", 9: "the old red hen ate all of the corn",
    }
    texts = {}
    for n in range(300):
        item = random.choice(list(items.values())) or ""
        changed = [
            random.choice([w, w.lower(), str(random.randrange(9)), "Zoe"]) if random.random() < n % 4 / 12 else w
            for w in item.split()
        ]
        copy = " ".join(changed).lower() if n % 5 == 0 else " ".join(changed)
        texts[n] = random.choice([f"{words(n, 5)} {copy} - {words(n + 1, 4)}", copy, words(n, 60), f"{copy} {copy}"])
    table = docs(spark, *texts.values())
    rows = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontam.contaminated(table.union(table), rows.union(rows)).collect()
    got = sorted((r.doc_id, r.item_id) for r in found)
    assert got == sorted(brute_contaminated(texts, items)) and {i for _, i in got} >= {1, 2, 3, 4, 5, 9}


def test_repeated_rows_and_lower_case_copies(spark):
    items = spark.createDataFrame([(1, "Mr Smith of London sold three old clocks to Mrs Brown of Leeds last week")], "item_id long, text string")
    text = items.first().text
    one_window = " ".join(text.split()[:8]) + " " + words(4, 20)
    table = docs(spark, text.lower(), one_window)
    found = decontam.contaminated(table.union(table).union(table), items).collect()
    assert [(r.doc_id, r.exact) for r in found] == [(0, True)]


# 5. Chat


def test_snapshots_collapse_to_maximal_conversations(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "bot", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "bot", "yo")]
    turns += [(3, 2, "user", None), (4, 0, "user", "hi"), (4, 1, "bot", "no"), (5, 0, "user", "hi"), (5, 1, "bot", "no")]
    turns += [(4, 0, "user", "hi"), (None, 0, "user", "lost"), (6, None, "user", "lost"), (7, 300, None, "late"), (7, 0, "user", "x")]
    table = spark.createDataFrame([(*t, "p") for t in turns], "conv_id long, turn long, role string, text string, part string")
    rows = {(r.conv_id, r.part): r.rendered for r in chat.chats(table).collect()}
    assert set(rows) == {(3, 0), (4, 0), (7, 0), (7, 1)}
    assert rows[4, 0] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>bot\nno<|im_end|>\n"
    assert rows[7, 1] == "<|im_start|>\nlate<|im_end|>\n"
    assert chat.chats(table.limit(0)).count() == 0


def test_null_and_empty_roles_and_texts_differ(spark):
    turns = [(1, 0, "x", None), (2, 0, None, "x"), (3, 0, "", "x"), (4, 0, "x", ""), (5, 0, None, "x")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert sorted(r.conv_id for r in chat.chats(table).collect()) == [1, 2, 3, 4]


# 6. Exact top-k


def test_top_k_matches_brute_force(spark):
    random = np.random.default_rng(1)
    vectors = np.round(random.normal(size=(300, 6)), 1)
    vectors[5] = vectors[20] = 0  # ties all over
    rows = [(n, [float(x) for x in v], 1) for n, v in enumerate(vectors)]
    odd = [(300, None, 1), (320, [1.0, None], 1), (340, [float("nan")] * 6, 1), (360, [], 1), (None, [0.0] * 6, 1)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank int")
    found = topk.top_k(table.where("vec_id % 20 = 0"), table, k=7).collect()
    whole = np.floor(64 * vectors.astype(np.float32).astype(float)).astype(int)
    for q in range(0, 300, 20):
        scores = whole @ whole[q]
        best = sorted((-s, n) for n, s in enumerate(scores) if n != q)[:7]
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q)
        assert got == [(k + 1, n, -s) for k, (s, n) in enumerate(best)]
    assert {r.query_id for r in found} == set(range(0, 300, 20))
    few = topk.top_k(table.where("vec_id = 0"), table.where("vec_id < 3"), k=7)
    assert few.count() == 2 and topk.top_k(table.limit(0), table).count() == 0


def test_threshold_lists_stop_early():
    vectors = np.random.default_rng(3).integers(-50, 50, (5000, 2)).astype(float)
    ids, queries = np.arange(5000), np.array([[3.0, -2.0], [1.0, 4.0]])
    best = fagin.Best(2, 5)
    met = topk.search(fagin.Lists(vectors), ids, queries, np.array([-1, -1]), np.arange(2), best)
    assert met < 1000
    for slot, query in enumerate(queries):
        scores = vectors @ query
        assert best.ids[slot].tolist() == sorted(ids, key=lambda n: (-scores[n], n))[:5]


def test_scores_beyond_a_long_are_compared_exactly(spark):
    rows = [[1e20, 0.0], [3e18, 1.0], [-1e20, 2.0], [1e20, 1.0], [1e300, 1e308], [0.5, 0.25], [0.0, 0.0]]
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    whole = [[int(x) * 64 if abs(x) > 1e300 else math.floor(64 * x) for x in row] for row in rows]
    found = topk.top_k(table, table, k=6).collect()
    for q, query in enumerate(whole):
        scores = [(-sum(a * b for a, b in zip(query, w)), n) for n, w in enumerate(whole) if n != q]
        held = lambda s: max(-(2**63), min(2**63 - 1, s))
        want = [(k + 1, n, held(-s)) for k, (s, n) in enumerate(sorted(scores))]
        assert sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q) == want


# 7. Personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_base_spans_are_those_of_the_plain_patterns():
    random.seed(5)
    for _ in range(20_000):
        text = "".join(random.choices("ab.@@-+% 0123456789..  ()é", k=random.randint(0, 50)))
        plain = [(k, *m.span()) for k in pii.KINDS for m in re.finditer(PLAIN[k], text) if pii.valid(k, m.group())]
        assert pii.base_spans(text) == plain, text


def test_personal_data_tables(spark):
    text = "mail é a.b@c.de or +1 (555) 123-4567, ip 10.0.0.1, card 4929 3483 8514 6306 end"
    table = docs(spark, text, None, "", text, "300.1.1.1 and 4929348385146307", "x" * 50_000)
    rows = pii.personal_data(table).withColumn("spans", pii.all_spans()).orderBy("doc_id").collect()
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows[:3]] == [(1, 1, 1, 1), (0,) * 4, (0,) * 4]
    assert rows[0].base == rows[0].spans == rows[3].spans and rows[4].base == ""
    assert [x.split(":")[0] for x in rows[0].spans.split(",")] == list(pii.KINDS)
    assert rows[0].redacted == "mail é [EMAIL] or [PHONE], ip [IP], card [CARD] end" and rows[1].redacted is None
    assert pii.personal_data(table.limit(0)).count() == 0


def test_trees_add_spans_in_looser_forms(spark):
    random.seed(8)
    phones = [f"call me at +1 ({random.randint(200, 999)}) {random.randint(200, 999)}-{random.randint(1000, 9999)} today" for _ in range(200)]
    junk = [f"number {random.randint(10**6, 10**9)} of many" for _ in range(200)]
    found = pii.fit(docs(spark, *phones, *junk)).spans("call me at (415) 555-2671 today")
    assert found[0] == [] and found[1] == [("phone", 11, 25)]


# 8. WARC


def test_archives_round_trip(spark, tmp_path):
    pages = [(1, "http://a", "<p>é</p>"), (2, "u\nv", "<p>é</p>"), (9, None, None), (4, "x", ""), (5, "y", "z" * 90_000), (None, "n", "n")]
    table = spark.createDataFrame([(*p, "d") for p in pages], "page_id long, url string, html string, payload string")
    manifest = warc.write_archives(table, str(tmp_path / "w"), archive_bytes=1000)
    rows = {r.page_id: r for r in warc.read_archives(manifest, str(tmp_path / "w")).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in rows.items()} == {
        1: ("revisit", 2), 2: ("response", None), 9: ("response", None), 4: ("revisit", 9), 5: ("response", None)
    }
    assert rows[1].payload_bytes == 9 and rows[1].payload_digest == rows[2].payload_digest
    assert rows[2].payload == "<p>é</p>".encode()
    empty = warc.write_archives(table.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(empty, str(tmp_path / "e")).count() == 0


def test_damaged_archives_are_refused():
    dictionary = b"some bytes that come up again and again" * 10
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    made = warc.make_record(7, "u", b"payload", warc.digest(b"payload"), "2024-01-01T00:00:00Z")
    whole = warc.dictionary_frame(dictionary) + packer.compress(made)
    assert [r["page_id"] for r in warc.read_archive(whole)] == [7]
    for bad in (whole[8:], whole[:-3], whole[:20], warc.dictionary_frame(dictionary) + packer.compress(made.replace(b"payload\r\n\r\n", b"pay\r\n\r\n"))):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(bad))


# 9. Language


def test_languages(spark):
    random.seed(1)
    parts = {"en": ["the", "and", "ing", "tion"], "de": ["der", "und", "ung", "sch"]}
    rows = [(n, " ".join(random.choices(parts[k], k=30)), k) for n in range(400) for k in [["en", "de"][n % 2]]]
    rows += [(400, None, "en"), (401, "123 ?!", "de"), (402, "", None), (None, "the and the", None)]
    table = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    found = {r.doc_id: r for r in langid.languages(table).collect()}
    held = [r for r in found.values() if r.held_out and r.doc_id < 400]
    assert held and all(r.lang_pred == ["en", "de"][r.doc_id % 2] for r in held)
    assert [found[k].lang_pred for k in (400, 401, 402)] == ["und"] * 3 and found[402].score == 0
    kept = langid.known_languages(table)
    assert kept.columns == table.columns and {400, 401, 402}.isdisjoint(r.doc_id for r in kept.collect())
    assert langid.languages(table.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.languages(table.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# 10. Language-model scores


def test_cross_entropy_difference_prefers_the_target(spark):
    good = [" ".join(random.choices("alpha beta gamma delta".split(), k=40)) for _ in range(30)]
    bad = [" ".join(random.choices("one two three four alpha".split(), k=40)) for _ in range(30)]
    table = docs(spark, *good, *bad, None, "")
    target = spark.createDataFrame([(n,) for n in range(20)] + [(None,), (3,)], "doc_id long")
    rows = lmscore.cross_entropy_difference(table, target).orderBy("doc_id").collect()
    assert max(r.score for r in rows[20:30]) < min(r.score for r in rows[30:60])
    assert [(r.n_tokens, r.score) for r in rows[60:]] == [(0, None)] * 2
    assert lmscore.cross_entropy_difference(table.limit(0), target).count() == 0
    assert lmscore.cross_entropy_difference(table, target.limit(0)).where("score is null").count() == 2


def test_digests_are_of_the_packed_ids(spark):
    rows = bpe.encode(docs(spark, "abc"), PATH).select(F.sha2("ids", 256).alias("h"), bpe.token_count("ids").alias("n"))
    ids = Tokenizer.from_file(PATH).encode("abc", add_special_tokens=False).ids
    packed = np.array(ids, "<u4").tobytes()
    assert rows.first() == (hashlib.sha256(packed).hexdigest(), len(ids))
    assert json.dumps(ids)


def test_language_sample_is_the_first_ids_of_each_language(spark):
    rows = spark.range(4000).selectExpr(
        "id as doc_id", "case when id % 100 = 0 then 'de' else 'en' end as lang"
    )
    again = spark.range(300).selectExpr("7L as doc_id", "'fr' as lang")
    found = langid._chosen(rows.union(again), 50).toPandas()
    placed = rows.withColumn("place", langid.spread("doc_id", 9)).orderBy("place").toPandas()
    for lang in ("en", "de"):
        first = placed[placed["lang"] == lang]["doc_id"][:50]
        assert sorted(found[found["lang"] == lang]["doc_id"]) == sorted(first)
    assert found[found["lang"] == "fr"]["doc_id"].tolist() == [7]


# Samples, settings and brute force of the fitted models


def test_repeated_ids_neither_flood_nor_empty_the_samples(spark, monkeypatch):
    """One id repeated 2,000 times with different texts, among 60 others of its language."""
    sizes = []
    collect = type(spark.range(1)).toPandas

    def counting(df):
        found = collect(df)
        sizes.append(len(found))
        return found

    monkeypatch.setattr(type(spark.range(1)), "toPandas", counting)
    texts = [f"the number {n} the and a.b{n}@c.de 4111 1111 1111 1111" for n in range(2060)]
    rows = [(0 if n < 2000 else 4 * n, t, "en") for n, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = sorted({r[0] for r in rows})
    learnt = [i for i in ids if zlib.crc32(str(i).encode()) % 4 != 2]
    chosen = langid._chosen(table.where(~langid.held_out("doc_id")).select("doc_id", "lang"), 1500)
    assert sorted(r.doc_id for r in chosen.collect()) == learnt
    langid.fit(table, 30)
    assert max(sizes) <= 30
    labels = spark.createDataFrame([(i, i % 8 // 4) for i in ids] * 50, "doc_id long, label int")
    quality.fit(table, labels, 40)
    assert max(sizes) <= 40
    sizes.clear()
    pii.fit(table, 20)
    assert sum(sizes) <= 20 * 16


def test_languages_answer_as_a_plain_loop_does():
    rng = np.random.default_rng(5)
    model = langid.Model(["a", "b", "c"], rng.normal(size=(langid.BUCKETS, 3)), rng.normal(size=3), 0.7, 0.4)
    for text in ("The quick fox", "ÄÖ ü " * 400_000, "x"):
        counts = langid.subword_counts(text)
        logits = [
            (sum(int(counts[b]) * model.table[b, k] for b in np.flatnonzero(counts)) / counts.sum() + model.bias[k]) / 0.7
            for k in range(3)
        ]
        shares = [math.exp(x - max(logits)) for x in logits]
        name, score = model.predict(text)
        assert name == "abc"[int(np.argmax(logits))] and score == pytest.approx(max(shares) / sum(shares))
    assert model.predict("12 !?") == ("und", 0.0) and model.predict(None) == ("und", 0.0)


def scalar_walk(model, row):
    """A row down every tree by comparisons, one at a time."""
    total = model.bias
    for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + math.exp(-(model.scale * total + model.shift)))


def test_trees_score_as_a_scalar_walk_does():
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(3000, 4))
    rows[:50] = 0
    labels = (rows[:, 0] + rows[:, 2] ** 2 > 0.5) | (rng.random(3000) < 0.1)
    model = gbt.fit(rows, labels)
    assert model.probability(rows[:300]) == pytest.approx([scalar_walk(model, row) for row in rows[:300]])


def brute_losses(texts, targets, word_share, bigram_share):
    """Mean losses of both models by plain counters."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    counts = [Counter(w for i, s in enumerate(split) if i in which for w in s) for which in (range(len(texts)), targets)]
    total = [sum(c.values()) for c in counts]
    keep = lambda c, share: {w for w in c[0] if any(c[k][w] and c[k][w] >= share * total[k] for k in (0, 1))}
    known = keep(counts, word_share)
    ids = [["<s>", *(w if w in known else "?" for w in s)] for s in split]
    pairs = [Counter(p for i, s in enumerate(ids) if i in which for p in zip(s, s[1:])) for which in (range(len(texts)), targets)]
    often = keep(pairs, bigram_share)
    size, losses = len(known) + 2, []
    for k, weight in ((0, total[1] / total[0]), (1, 1.0)):
        single = Counter(w for i, s in enumerate(ids) if i in (range(len(texts)), targets)[k] for w in s[1:])
        starts = sum(texts[i] is not None for i in (range(len(texts)), targets)[k])

        def loss(a, b, k=k, weight=weight, single=single, starts=starts):
            one = (weight * single[b] + 1) / (weight * total[k] + size - 1)
            context = starts if a == "<s>" else single[a]
            blend = lmscore.BLEND if context else 0
            own = blend * pairs[k][a, b] / context if context and (a, b) in often else 0
            return -math.log(own + (1 - blend) * one)

        losses.append([np.mean([loss(*p) for p in zip(s, s[1:])]) if len(s) > 1 else None for s in ids])
    return losses[1], losses[0]


@pytest.mark.parametrize("shares", [(1e-5, 1e-6), (0.02, 0.01)])
def test_losses_are_those_of_plain_counters(spark, monkeypatch, shares):
    monkeypatch.setattr(lmscore, "WORD_SHARE", shares[0])
    random.seed(14)
    texts = [" ".join(random.choices("abcdefghijklmnop"[: 4 + n % 12], k=random.randint(1, 40))) for n in range(80)]
    texts += [None, "", texts[0], "rare words here " * 9, "x " * 30_000]
    targets = set(range(0, 80, 7)) | {83}
    table = docs(spark, *texts)
    marked = table.select("text", F.col("doc_id").isin(list(targets)).alias("target"))
    models = lmscore.train(marked, *shares)
    want = brute_losses(texts, targets, *shares)
    for n, text in enumerate(texts):
        _, target, background = models.score(text)
        got = [target, background]
        assert got == [None, None] if want[0][n] is None else got == pytest.approx([w[n] for w in want])


def test_a_file_with_two_ways_to_a_token_is_refused():
    vocab = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258}
    with pytest.raises(ValueError, match="several merges"):
        bpe.Automaton(vocab, [(97, 98), (98, 99), (256, 99), (97, 257)], {})


def test_no_operator_leaves_a_setting_behind(spark, tmp_path):
    def settings():
        return {r.key: r.value for r in spark.sql("SET").collect()}

    before = settings()
    table = docs(spark, *[words(n, 30) for n in range(8)], None)
    table = table.withColumn("lang", F.lit("en"))
    bpe.encode(table, PATH).collect()
    neardup.near_duplicates(table, words=2).collect()
    langid.languages(table).collect()
    pii.personal_data(table).collect()
    labels = spark.createDataFrame([(n, n % 2) for n in range(8)], "doc_id long, quality int")
    quality.quality_scores(table, labels).collect()
    lmscore.cross_entropy_difference(table, labels).collect()
    decontam.contaminated(table, spark.createDataFrame([(1, ITEM)], "item_id long, text string")).collect()
    pages = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string")
    warc.read_archives(warc.write_archives(pages, str(tmp_path)), str(tmp_path)).collect()
    mixing.mix(table).collect()
    assert settings() == before


def test_stretches_are_free_where_no_span_is():
    random.seed(15)
    for _ in range(300):
        spans = [(s, s + random.randint(1, 9)) for s in random.choices(range(60), k=random.randint(0, 6))]
        taken = pii._Taken(spans)
        for _ in range(8):
            start = random.randrange(60)
            end = start + random.randint(1, 9)
            free = all(e <= start or end <= s for s, e in spans)
            assert taken.free(start, end) == free
            if free:
                taken.add(start, end)
                spans.append((start, end))


def brute_added(detector, text):
    """Of the proposals, best first, those that pass and touch nothing taken before."""
    base = pii.base_spans(text)
    taken, added = [x[1:] for x in base], []
    found = list(dict.fromkeys(pii.proposals(text)))
    scored = [(-float(detector.trees.probability(np.array([pii.features(text, *x)]))[0]), x) for x in found]
    for score, (kind, start, end) in sorted(scored, key=lambda x: (x[0], x[1][1])):
        if -score >= detector.thresholds[kind] and all(e <= start or end <= s for s, e in taken):
            added.append((kind, start, end))
            taken.append((start, end))
    return added


def test_added_spans_are_those_of_a_plain_loop():
    rng = np.random.default_rng(16)
    random.seed(16)
    rows = rng.normal(size=(500, pii.WIDTH)) * 10
    trees = gbt.fit(rows, rows[:, 5] + rows[:, 7] > 0)
    detector = pii.Detector(trees, dict.fromkeys(pii.KINDS, 0.4))
    for _ in range(60):
        parts = ["a.b at c dot de", "10 . 0 . 0 . 1", "4929 3483.8514-6306", "(555) 123 4567", "x", "call", "1.2.3.4", "y@z.com"]
        text = " ".join(random.choices(parts, k=random.randint(0, 30)))
        assert sorted(detector.spans(text)[1]) == sorted(brute_added(detector, text))


def test_workers_forget_words_of_other_operators():
    decontam._coded("some words to remember")
    assert decontam._CODES
    list(common.in_slices(decontam._templates)([]))
    assert decontam._CODES
    list(common.in_slices(langid._sparse)([]))
    assert not decontam._CODES


def test_trees_learn_from_every_document_and_span(spark, monkeypatch):
    """One text with more spans than any sample took, and cells beyond the driver's share."""
    random.seed(18)
    many = " ; ".join(f"call +1 ({random.randint(200, 999)}) 555-{n:04d}" for n in range(300))
    junk = [f"number {random.randint(10**6, 10**9)} of 10.0.0.{n}" for n in range(120)]
    table = docs(spark, many, *junk)
    cells = {}
    summed = pii._summed

    def seen(found, limit):
        cells[limit] = found.agg(F.sum("n")).first()[0]
        return summed(found, limit)

    monkeypatch.setattr(pii, "_summed", seen)
    monkeypatch.setattr(pii, "TREES", 2)
    here, there = pii.fit(table), pii.fit(table, 3)
    # Each phone also holds a run of digits that is no card, and a looser phone.
    spans = [x for t in (many, *junk) for x in [*pii.matches(t), *pii.proposals(t)]]
    bases = sum(len(pii.base_spans(t)) for t in (many, *junk))
    assert bases <= min(cells.values()) == max(cells.values()) <= len(spans) and bases == 420
    assert len(here.trees.leaf) == 2 and here.thresholds == there.thresholds
    for one, other in zip(vars(here.trees).values(), vars(there.trees).values()):
        assert np.array_equal(one, other)


@pytest.mark.parametrize("shares", [(1e-5, 1e-6), (0.02, 0.01), (2, 2)])
def test_rare_words_and_bigrams_keep_their_counts(spark, monkeypatch, shares):
    """Whatever is broadcast, the losses are those of plain counters without any cut."""
    monkeypatch.setattr(lmscore, "WORD_SHARE", shares[0])
    monkeypatch.setattr(lmscore, "BIGRAM_SHARE", shares[1])
    random.seed(19)
    texts = [" ".join(random.choices("abcdefghijklmnop"[: 4 + n % 12], k=random.randint(1, 40))) for n in range(40)]
    texts += [None, "", texts[0], "rare words here " * 9, "x " * 3_000]
    targets = set(range(0, 40, 7)) | {43}
    target = spark.createDataFrame([(n,) for n in targets], "doc_id long")
    rows = lmscore.cross_entropy_difference(docs(spark, *texts), target).orderBy("doc_id").collect()
    want = brute_losses(texts, targets, 0, 0)
    assert [r.n_tokens for r in rows] == [len((t or "").split()) for t in texts]
    for row, one, other in zip(rows, *want):
        got = [row.target_loss, row.background_loss]
        assert got == [None, None] if one is None else got == pytest.approx([one, other])


@pytest.mark.parametrize("share_bytes", [100, 1 << 24])
def test_blocks_and_shares_change_no_loss(spark, monkeypatch, share_bytes):
    """Rows without id, repeated rows, and texts longer than a block."""
    monkeypatch.setattr(lmscore, "BLOCK_BYTES", 400)
    monkeypatch.setattr(lmscore, "SHARE_BYTES", share_bytes)
    random.seed(23)
    texts = [" ".join(random.choices("abcdefghijklmnop"[: 4 + n % 12], k=random.randint(1, 90))) for n in range(60)]
    texts += [None, "", " ", texts[0], "x " * 900]
    ids = [None if n % 9 == 4 else n // 2 for n in range(len(texts))]
    table = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    target = spark.createDataFrame([(n,) for n in range(0, 30, 4)] + [(None,)], "doc_id long")
    rows = lmscore.cross_entropy_difference(table, target).collect()
    marked = {n for n, i in enumerate(ids) if i is not None and i % 4 == 0 and i < 30}
    order = lambda x: [(-1 if y is None else y) for y in x]
    want = zip(ids, [len((t or "").split()) for t in texts], *brute_losses(texts, marked, 0, 0))
    got = [(r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in rows]
    for one, other in zip(sorted(map(order, got)), sorted(map(order, want)), strict=True):
        assert one == pytest.approx(other)


def test_runs_of_a_split_block_are_answered_apart():
    texts = ["a b a", "", "b c", "c d a b", None, "a a a b", "d e", "e", "a b c d"]
    rows = [(7, n, t, n % 2 == 0) for n, t in enumerate(texts)]
    names = ["block", "place", "text", "target"]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=names)

    def losses(*batches):
        counts = pa.Table.from_batches([x for b in batches for x in lmscore._counts(3)(iter([b]))])
        groups = {(k, s) for k, s in zip(counts["kind"].to_pylist(), counts["share"].to_pylist())}
        answers = pa.concat_tables(
            lmscore._answers(counts.filter((pc.field("kind") == k) & (pc.field("share") == s))) for k, s in groups
        )
        words = answers.filter(pc.field("kind") == lmscore.WORD)
        totals = [sum(words[c].to_pylist()) for c in ("distinct", "total", "total_t")]
        asking = pa.table({"place": range(len(texts)), "doc_id": range(len(texts)), "text": pa.array(texts)})
        return lmscore._losses((8, 4), *totals)(asking, answers).to_pylist()

    whole = losses(batch(rows))
    assert [r["n_tokens"] for r in whole] == [len((t or "").split()) for t in texts]
    assert losses(batch(rows[5:]), batch(rows[:5])) == whole
    assert losses(batch(rows[5:] + rows[:1]), batch(rows[1:2]), batch(rows[2:5])) == whole


def test_language_model_scores_take_little_disk(spark, monkeypatch):
    """What lies in shuffles and tables as each table is written, for texts of rare words."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(x.getPath()) for x in manager.localDirs()]

    def used(kind):
        return {f: f.stat().st_size for d in folders for f in d.rglob(kind)}

    spark._jvm.System.gc()
    before, most = set(used("shuffle_*")), []
    keep = Scratch.keep

    def keeping(scratch, df, **options):
        found = keep(scratch, df, **options)
        tables = sum(f.stat().st_size for f in Path(scratch.root.removeprefix("file:")).rglob("part-*"))
        most.append(tables + sum(n for f, n in used("shuffle_*").items() if f not in before))
        return found

    monkeypatch.setattr(Scratch, "keep", keeping)
    random.seed(24)
    texts = [" ".join(f"{random.getrandbits(14):x}" for _ in range(1000)) for _ in range(300)]
    table = docs(spark, *texts)
    target = spark.createDataFrame([(n,) for n in range(0, 300, 3)], "doc_id long")
    assert lmscore.cross_entropy_difference(table, target).where("score is null").count() == 0
    assert max(most) < 5 * sum(map(len, texts))
