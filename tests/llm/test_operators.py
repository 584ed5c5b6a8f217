"""Each text operator against brute force, and on nulls, ties, repeats, empty and odd tables."""

import hashlib
import html
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL, rows
from tidemark.llm import queries
from tidemark.llm.bin_packing import best_fit, complete_bins, cut, lower_bound, pack_documents
from tidemark.llm.components import components, link_items
from tidemark.llm.fuzzy_lines import fuzzy_lines, without_repeats
from tidemark.llm.grace_dedup import exact_groups, keep_one_each
from tidemark.llm.hash_tree_sharding import TREE, grown, shard_rows
from tidemark.llm.ngram_join import jaccard_groups, keep_one_per_group
from tidemark.llm.page_diff import common_lines, extract_main, main_text, page_blocks
from tidemark.llm.poisson_mixing import mix_sources
from tidemark.llm.preference_chat import neighbours, preference_pairs
from tidemark.llm.quality_rules import keep_good, quality_report
from tidemark.llm.suffix_dedup import removed_spans, repeated_bytes, suffix_ranks

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    values = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, long, "en", "a", 1), (4, long.upper(), "en", None, 1),
              (None, "only one line", "en", "b", 1), (None, long, "de", "b", 2), (5, "Twice", "en", "a", 5),
              (5, "Twice", "en", "a", 5), (5, "other text", "en", "a", 5), (6, "ß TWICE Straße", "de", "c", 3),
              (7, " \t\n\x0b\x0c\r ", "en", "c", 7), (8, "ab" * 4000, "en", "c", 8000), (9, "ß twice Straße", "de", "c", 3)]
    return spark.createDataFrame(values, SHAPE)


@pytest.fixture(scope="module")
def clashing(documents):
    """Extra columns named like those of the results."""
    return documents.limit(60).withColumns({c: F.lit("x") for c in (
        "row", "keep_id", "kept", "shard", "slot", "size", "piece", "length", "n_words", "key", "item", "raw", "doc", "h",
        "component_id", "mix_copy", "rank", "id", "rep", "content", "sig", "part", "position", "line_no", "_copies")})


OPERATORS = {
    "suffix": repeated_bytes, "ngram": jaccard_groups, "shard": shard_rows, "mix": mix_sources, "grace": exact_groups,
    "quality": quality_report, "lines": fuzzy_lines,
    "pack": lambda d: pack_documents(d, queries.RANKS, queries.PATTERN)}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_and_clashing_columns(spark, clashing, name):
    run = OPERATORS[name]
    assert run(spark.createDataFrame([], SHAPE)).count() == 0
    plain = clashing.select(*[c for c in ("doc_id", "text", "lang", "source", "n_chars")])
    ours = run(clashing).select(*run(plain).columns).drop("row", "mix_copy")
    assert rows(ours) == rows(run(plain).select(*ours.columns))


def test_exact_groups(spark, odd, documents):
    for docs in (odd, documents):
        data = [(r.doc_id, (r.text or "").translate(FOLD)) for r in docs.collect()]
        groups = defaultdict(list)
        for key, text in data:
            groups[text].append(key)
        want = Counter((k, max((x for x in groups[t] if x is not None), default=None), len(groups[t]),
                        hashlib.sha256(t.encode()).hexdigest()) for k, t in data)
        got = exact_groups(docs).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        kept = [r for r in got if r.kept]
        assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
        # Tables too small for the content pass the rest on to further levels.
        again = exact_groups(docs, table_bytes=3000, bucket_bytes=40_000)
        assert rows(again.drop("row", "kept")) == rows(exact_groups(docs).drop("row", "kept"))
    left = keep_one_each(odd)
    assert left.columns == odd.columns and left.count() == len({(r.text or "").translate(FOLD) for r in odd.collect()})


def shingles(text):
    words = WORD.findall((text or "").translate(FOLD))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def links(sets):
    where = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            where[g].add(i)
    near = defaultdict(Counter)
    for group in where.values():
        for a, b in itertools.combinations(sorted(group), 2):
            near[a][b] += 1
    return [(a, b) for a, found in near.items() for b, n in found.items()
            if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]


def groups_of(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_jaccard_groups(spark, odd, documents):
    pick = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    near = []
    for i in range(60):  # a group of near copies that are linked partly, by chains
        words = list(base)
        for _ in range(pick.randrange(6)):
            words[pick.randrange(120)] = f"n{pick.randrange(40)}"
        near.append((10_000 + i, " ".join(words)))
    more = spark.createDataFrame(near, "doc_id long, text string")
    for docs in (odd, documents.select("doc_id", "text").unionAll(more)):
        data = [(r.doc_id, shingles(r.text)) for r in docs.collect()]
        ids = [k for k, _ in data]
        groups = groups_of(len(data), links([s for _, s in data]))
        least = {g: min((ids[i] for i, x in enumerate(groups) if x == g and ids[i] is not None), default=None) for g in set(groups)}
        want = Counter((k, len(s), least[g]) for (k, s), g in zip(data, groups, strict=True))
        assert Counter(map(tuple, jaccard_groups(docs, bits=12).collect())) == want
        assert Counter(map(tuple, jaccard_groups(docs, bits=8, bucket_postings=500).collect())) == want
    left = keep_one_per_group(odd)
    assert left.columns == odd.columns and left.where("doc_id = 3").count() == 1 and left.where("doc_id = 4").count() == 0


def test_components(spark):
    pick = random.Random(3)
    edges = [(pick.randrange(400), pick.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 560)]
    edges = [e for e in edges if e[0] != e[1]]
    want = groups_of(600, edges)
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {i: want[i] for e in edges for i in e}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_linked_chains(spark):
    """Every true pair that shares a key is found: many seeds, each a group of keys and items of its own."""
    members, edges, item = [], set(), 0
    for seed in range(400):
        pick = random.Random(seed)
        size = pick.randrange(3, 14)
        group = pick.sample(range(item, item + 40), size)
        item += 40
        for key in range(pick.randrange(1, 4)):
            members += [(10 * seed + key, i) for i in group if not key or pick.random() < 0.6]
        edges |= {(min(a, b), max(a, b)) for a, b in zip(group, group[1:]) if pick.random() < 0.8}
    true = spark.createDataFrame(sorted(edges), "a long, b long")
    frame = spark.createDataFrame(members, "key long, item long").withColumn("n", F.lit(1))
    got = dict(rows(link_items(frame, ["n"], lambda raw: raw.select("a", "b").distinct(), lambda pairs: pairs.join(true, ["a", "b"]))))
    want = groups_of(item, edges)
    assert all(got.get(i, i) == want[i] for _, i in members)


def test_pairs_of_wide_keys_are_returned_once(spark):
    """Near copies share many keys: a pair is returned at the first of them, and no link is lost for it."""
    from tidemark.llm import components as module

    copies = spark.createDataFrame([(key, i) for key in range(12) for i in range(20)], "key long, item long")
    open_keys = module._open_keys(copies.withColumn("_c", F.col("item")), None, "key")
    assert module._across(open_keys, F.lit(True), None).count() == 190
    pick = random.Random(8)
    members, edges = [], set()
    for start in range(0, 1200, 40):
        group = list(range(start, start + 40))
        for key in range(pick.randrange(1, 60)):  # more keys than an item names
            members += [(60 * start + key, i, pick.randrange(5)) for i in group if pick.random() < 0.5]
        keys = {i: {k for k, j, _ in members if j == i} for i in group}
        edges |= {(a, b) for a, b in itertools.combinations(group, 2) if pick.random() < 0.03 and keys[a] & keys[b]}
    true = spark.createDataFrame(sorted(edges), "a long, b long")
    frame = spark.createDataFrame(members, "key long, item long, n long")
    got = dict(rows(link_items(frame, ["n"], lambda raw: raw.select("a", "b").distinct(), lambda pairs: pairs.join(true, ["a", "b"]),
                               order="key")))
    want = groups_of(1200, edges)
    assert all(got.get(i, i) == want[i] for _, i, _ in members)


def brute_spans(docs, length):
    """Per document (sorted), the bytes of strings that start earlier."""
    seen, out = set(), []
    for _, data in docs:
        mark, own = np.zeros(len(data), bool), []
        for s in range(len(data) - length + 1):
            piece = data[s:s + length]
            if piece in seen:
                mark[s:s + length] = True
            seen.add(piece)
        out.append(mark)
    return out


def test_repeated_bytes(spark, odd, documents):
    pick = random.Random(1)
    share = "".join(pick.choice("abcd ") for _ in range(400))
    extra = [(-5, share), (50_001, "x" + share[50:300] + "y" + share[100:230]), (50_002, "é" * 300), (50_003, "abc" * 200), (50_004, "b" * 99)]
    docs = documents.select("doc_id", "text").limit(120).unionAll(spark.createDataFrame(extra, "doc_id long, text string"))
    data = sorted((r.doc_id, (r.text or "").encode()) for r in docs.collect())
    for options in ({}, {"hot_phrases": 1, "bucket_phrases": 300, "bucket_bytes": 20_000}):
        got = {r.doc_id: r for r in repeated_bytes(docs, **options).collect()}
        for (key, text), mark in zip(data, brute_spans(data, 100), strict=True):
            kept = np.frombuffer(text, np.uint8)[~mark].tobytes()
            n_spans = int((np.diff(np.concatenate([[0], mark.view(np.int8)])) == 1).sum())
            assert tuple(got[key]) == (key, len(text), int(mark.sum()), n_spans, hashlib.sha256(kept).hexdigest())
    result = repeated_bytes(odd)
    assert result.count() == odd.count()
    twice = result.where("doc_id = 3").first()
    assert twice.n_removed == twice.n_bytes  # the null key comes first and has the same text
    assert removed_spans([(0, 1), (50, 2), (200, 1)], 100) == [(0, 151), (200, 300)]
    text = np.frombuffer(b"banana" * 4, np.uint8)
    ranks = suffix_ranks(text, 12)
    places = range(len(text) - 11)
    assert all((ranks[i] < ranks[j]) == (bytes(text[i:i + 12]) < bytes(text[j:j + 12])) for i in places for j in places)


def test_packing(spark, odd, documents):
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reader.encode_special_tokens = True
    for docs in (odd, documents):
        got = pack_documents(docs, queries.RANKS, queries.PATTERN, chunk_rows=50).collect()
        want = []
        for r in docs.collect():
            ids = [*reader.encode(r.text or "", add_special_tokens=False).ids, 2]
            for piece, (start, n) in enumerate(cut(len(ids), 1024)):
                want.append((r.doc_id, piece, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())))
        assert Counter(tuple(r[:5]) for r in got) == Counter(want)
        bins = defaultdict(list)
        for r in got:
            bins[r.sequence_id].append((r.offset, r.length))
        for places in bins.values():
            places.sort()
            assert [o for o, _ in places] == [0, *itertools.accumulate(n for _, n in places)][:-1]
            assert sum(n for _, n in places) <= 1024
        assert len(bins) <= sum(n for _, n in best_fit(Counter(w[3] for w in want), 1024))
    assert cut(1024, 1024) == [(0, 1024)] and cut(2050, 1024) == [(0, 2), (2, 1024), (1026, 1024)] and cut(1, 1024) == [(0, 1)]


def test_packing_takes_the_ids_of_the_contract(spark):
    """Quoted special tokens and very long white space, against the reader as it is by default."""
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one <|endoftext|> two", "<|endoftext|><|endoftext|>", "x<|endoftext|", " " * 1_200_000, "a" + "\n" * 1_200_000 + "b",
             "\x85" * 1_200_000, " " * 99_999 + "x", "x" + " " * 100_000, "word " * 60_000, ""]
    want = Counter()
    for i, text in enumerate(texts):
        ids = [*reader.encode(text, add_special_tokens=False).ids, 2]
        want.update((i, p, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())) for p, (s, n) in enumerate(cut(len(ids), 1024)))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert Counter(tuple(r[:5]) for r in pack_documents(frame, queries.RANKS, queries.PATTERN).collect()) == want


def test_bin_completion_finds_the_optimum():
    def fewest(items, size):
        best = [len(items)]

        def place(i, left):
            if len(left) >= best[0]:
                return
            if i == len(items):
                best[0] = len(left)
                return
            for at in {left[k]: k for k in range(len(left)) if left[k] >= items[i]}.values():
                place(i + 1, [*left[:at], left[at] - items[i], *left[at + 1:]])
            place(i + 1, [*left, size - items[i]])

        place(0, [])
        return best[0]

    for seed in range(25):
        pick = random.Random(seed)
        items = sorted((pick.randint(3, 60) for _ in range(9)), reverse=True)
        plan = complete_bins(Counter(items), 100)
        assert Counter(x for f, n in plan for x in f for _ in range(n)) == Counter(items) and all(sum(f) <= 100 for f, _ in plan)
        assert lower_bound(Counter(items), 100) <= fewest(items, 100) == sum(n for _, n in plan)


def test_discarded_alternatives_are_recorded(caplog):
    items = Counter(random.Random(seed).randint(3, 60) for seed in range(60))
    plan = complete_bins(items, 100, most_stack=0)
    assert sum(n * len(f) for f, n in plan) == 60
    assert best_fit(items, 100) and ("discarded" in caplog.text) == (sum(n for _, n in best_fit(items, 100)) > lower_bound(items, 100))


def test_sharding(odd, documents):
    for docs in (odd, documents):
        got = shard_rows(docs, chunk_rows=10).collect()
        assert len(got) == docs.count()
        for shard in range(8):
            slots = sorted(r.slot for r in got if r.shard == shard)
            assert slots == list(range(len(slots)))
        assert all(r.grown_shard in (r.shard, 8) for r in got)
    sizes = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in shard_rows(odd).collect()) == sizes
    assert grown(TREE, 8).weight == TREE.weight + 1


def test_mixing(spark, odd, documents):
    once = mix_sources(documents)
    assert rows(once) == rows(mix_sources(documents.repartition(7)))  # the seed decides, not the layout
    order = [r.mix_order for r in once.collect()]
    assert order == sorted(order)
    many = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") < 5000, "big").otherwise("small").alias("source"))
    counts = {r.source: r["count"] for r in mix_sources(many, weights={"small": 3.0}).groupBy("source").count().collect()}
    assert abs(counts["small"] - 4500) < 300 and abs(counts["big"] - 1500) < 200  # Poisson around the targets
    assert mix_sources(many.where("doc_id < 5001"), weights={"small": 400.0}).where("source = 'small'").count() > 4000
    assert mix_sources(odd, marks=False).columns == odd.columns


def test_quality(odd, documents):
    for docs in (odd, documents):
        got = Counter(tuple(r)[:7] for r in quality_report(docs).collect())
        want = []
        for r in docs.collect():
            text = r.text or ""
            words = WORD.findall(text)
            lines = [x for x in text.split("\n") if WORD.search(x)]
            seen = Counter(zip(words, words[1:], words[2:]))
            hit = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if seen[w] > 1 for k in range(3)}
            want.append((r.doc_id, len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
                         len(lines) - len(set(lines)), len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words)))
        assert got == Counter(want)
    labels = documents.sparkSession.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1")
    good = quality_report(documents).where("not base_failed").join(labels, "doc_id")
    assert good.where("not kept").count() <= 0.01 * good.count()
    plan = keep_good(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and keep_good(odd).columns == odd.columns


def test_chat(spark):
    turns = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (1, 0, "user", "q"), (1, 1, "assistant", "b"), (1, 2, "user", None),
             (2, 0, "user", "alone"), (None, 0, "user", "lost"), (4, 0, "user", "x"), (5, 0, "user", "x"), (5, 0, "user", "x"),
             (6, None, None, "y"), (7, 0, "user", "z")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    got = preference_pairs(frame, *neighbours()).collect()
    text = defaultdict(str)
    for r in sorted(got, key=lambda r: r.position):
        assert r.char_start == len(text[r.pair_id, r.part]) and r.n_chars == len(r.segment)
        text[r.pair_id, r.part] += r.segment
    assert text[0, "prompt"] == "<|user|>\nq<|end|>\n" and text[0, "chosen"] == "<|assistant|>\na<|end|>\n"
    assert text[0, "rejected"] == "<|assistant|>\nb<|end|>\n<|user|>\n<|end|>\n"
    assert text[2, "prompt"] == "<|user|>\nx<|end|>\n" and (2, "chosen") not in text  # equal sides: all prompt
    assert text[1, "unpaired"] and text[None, "unpaired"] and not [r for r in got if r.trained and r.role != "assistant"]
    assert preference_pairs(frame.where("false"), *neighbours()).isEmpty()


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header>
<nav><ul><li><a>Home</a></li></ul></nav><div class="cookie-notice">Accept</div>{}<aside>Side</aside>
<section id="comments"><p>Reader</p></section><form>Mail</form><footer>&copy; x</footer></body>"""


def test_pages(spark):
    marked = PAGE.format("<article><h1>A &amp;\n B</h1><p>one<br><p>two <b>x</b><div class='ad'>buy</div></article>")
    assert main_text(page_blocks(marked), [], None) == "A & B\none\ntwo x"
    plain = [PAGE.format(f"<div><p>shared line</p><p>own {i}</p></div>") for i in range(3)]
    pages = [(1, "http://h.org/a/1", plain[0]), (2, "https://h.org/a/2?x=1", plain[1]), (3, "http://other.org/a/1", plain[2]),
             (4, "http://m.org/x", marked), (5, None, None), (None, "", ""), (6, "http://m.org/x", marked), (6, "http://m.org/x", marked)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("row", F.lit(1))
    got = Counter((r.page_id, r.text, r.n_chars) for r in extract_main(frame, parts=3).collect())
    same = "A & B\none\ntwo x"
    assert got == Counter([(1, "own 0", 5), (2, "own 1", 5), (3, "shared line\nown 2", 17), (4, same, len(same)), (5, "", 0),
                           (None, "", 0), (6, same, len(same)), (6, same, len(same))])
    assert extract_main(frame.where("false")).isEmpty()
    pick = random.Random(2)
    for _ in range(40):
        a, b = ([pick.randrange(4) for _ in range(pick.randrange(9))] for _ in "ab")
        best = max(len(x) for n in range(len(a) + 1) for x in itertools.combinations(range(len(a)), n)
                   if (it := iter(b)) and all(a[i] in it for i in x))
        assert len(common_lines(a, b)) == best


def test_every_page_of_the_table(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r.text for r in extract_main(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


def test_lines(spark, odd, documents):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    near = " ".join([*words[:299], "zz"])
    values = [(1, "Released under licence 3.\nshort\n" + " ".join(words)), (2, "released   under, licence 4\nshort\n" + near),
              (3, " ".join(reversed(words)))]
    frame = spark.createDataFrame(values, "doc_id long, text string")
    got = {(r.doc_id, r.line_no): r for r in fuzzy_lines(frame).collect()}
    assert not got[2, 0].kept and got[1, 0].line_group == got[2, 0].line_group  # equal when normalised
    assert got[2, 1].kept and got[2, 1].line_group is None
    assert got[1, 2].line_group == got[2, 2].line_group and not got[2, 2].kept
    assert got[3, 0].kept and got[3, 0].line_group != got[1, 2].line_group  # same words, other order
    left = without_repeats(frame.withColumn("raw", F.lit(1)))
    assert left.columns == ["doc_id", "text", "raw"] and {r.doc_id: r.text for r in left.collect()}[2] == "short"
    assert fuzzy_lines(odd).count() == sum((r.text or "").count("\n") + 1 for r in odd.collect())
    every = fuzzy_lines(documents)
    grouped = every.where("line_group is not null")
    assert grouped.where("kept").count() == grouped.select("line_group").distinct().count()


def edits(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def test_near_lines_are_found(spark):
    """Changed words and typos in lines of 5 to 100 words, and in a script without blanks; recall against brute force."""
    pick = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(pick.choices(letters, k=pick.randrange(2, 10))) for _ in range(3000)]
    values, pairs = [], []
    for n in (5, 7, 10, 15, 20, 40, 70, 100):
        for case in range(24):
            line = " ".join(pick.choices(vocabulary, k=n))
            other = list(line)
            if case < 8:  # one word
                words = line.split()
                words[pick.randrange(n)] = pick.choice(vocabulary)
                other = " ".join(words)
            else:  # typos: one, or up to about the bound
                for _ in range(1 if case < 16 else len(line) // 11):
                    at = pick.randrange(len(other))
                    other[at:at + pick.randrange(2)] = pick.choice(letters)
                other = "".join(other)
            pairs.append((line, other))
    for n in (12, 40, 200):
        line = "".join(chr(0x4E00 + pick.randrange(3000)) for _ in range(n))
        pairs.append((line, line[:n // 2] + "\u4e00" + line[n // 2 + 1:]))
    for i, (line, other) in enumerate(pairs):
        values += [(2 * i, line), (2 * i + 1, other)]
    got = {r.doc_id: r.line_group for r in fuzzy_lines(spark.createDataFrame(values, "doc_id long, text string")).collect()}
    near = [i for i, (x, y) in enumerate(pairs) if 10 * edits(x, y) <= max(len(x), len(y))]
    found = [i for i in near if got[2 * i] == got[2 * i + 1]]
    assert len(near) > 120 and len(found) >= 0.97 * len(near), (len(near), len(found))
    assert not [i for i in range(len(pairs)) if i not in near and got[2 * i] == got[2 * i + 1]]


def test_common_features_are_counted_on_all_lines(spark):
    """Every line counts towards what is common, whichever of them a hash would pick."""
    from tidemark.llm import fuzzy_lines as module

    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("alpha beta gamma delta x"), F.col("id").cast("string")).alias("text"))
    features = module.line_features(module._lines(docs, "doc_id", "text"), 1)
    want = Counter(h % module._RANGES for r in features.collect() for h in [*r.words, *r.grams])
    least = max(sum(want.values()), module._LEAST_TOTAL)
    assert list(module._levels(features)) == [want[i] * module._COMMON > least for i in range(module._RANGES)] and any(module._levels(features))


def test_lines_leave_one_table(spark):
    from tidemark.session import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five six.")], "doc_id long, text string")
    assert sorted(r.kept for r in fuzzy_lines(docs).collect()) == [False, True]
    assert [p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before] == ["line-groups"]


def test_lines_remove_what_is_read(spark, monkeypatch):
    """The spelt lines of a round and the members go before the next round stores its own."""
    from tidemark.llm import components as module
    from tidemark.session import shared_dir

    folder, seen, plain = Path(shared_dir(spark).removeprefix("file:")), [], module.written
    before = set(folder.iterdir())

    def look(df, label, *rest):
        if label == "cross-links":
            seen.append(sorted({p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before} & {"spelt-lines", "line-members"}))
        return plain(df, label, *rest)

    monkeypatch.setattr(module, "written", look)
    # Four groups of lines around common words, so that members of one key are left in different components.
    words = "alder birch cedar dogwood elm fir".split()
    texts = [" ".join([*words, *[f"{a}{chr(97 + i)}{chr(97 + j)}" for j in range(4)]]) for a in "pqrs" for i in range(6)]
    assert fuzzy_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == len(texts)
    assert seen and not any(seen), seen


def test_pairs_are_compared_in_slices(spark, monkeypatch):
    """Lines of one group and of none are the same in many slices, and each slice is a table of its own."""
    from tidemark.llm import fuzzy_lines as module

    seen, plain = [], module.written
    monkeypatch.setattr(module, "_PAIRS", 6)
    monkeypatch.setattr(module, "written", lambda df, label, *rest: seen.append(label) or plain(df, label, *rest))
    words = "alder birch cedar dogwood elm fir".split()
    texts = [" ".join([*words, *[f"{a}{a}{a}{a}{a}{a}{j}x" for j in "klmn"], "z" * (i // 2)]) for a in "pqrs" for i in range(6)]
    got = {r.doc_id: r.line_group for r in fuzzy_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    near = [(a, b) for a, b in itertools.combinations(range(24), 2) if 10 * edits(texts[a], texts[b]) <= max(len(texts[a]), len(texts[b]))]
    want = groups_of(24, near)
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a, b in itertools.combinations(range(24), 2))
    assert seen.count("line-links") > seen.count("spelt-lines")


def test_equal_lines_of_few_words(spark):
    texts = ["All rights reserved\n版权所有\nid 7\nปลอดภัย", "all rights  reserved.\n版权所有\nid 8\nปลอดภัย"]
    got = {(r.doc_id, r.line_no): r for r in fuzzy_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[1, i].kept for i in range(4)] == [False, False, True, False] and got[1, 2].line_group is None


def test_pipeline_stages(spark, documents, tmp_path):
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == documents.columns
        docs.write.parquet(str(tmp_path / name))
        docs = seen[name] = spark.read.parquet(str(tmp_path / name))
    ids = {n: [r.doc_id for r in d.select("doc_id").collect()] for n, d in seen.items()}
    verdict = {r.doc_id for r in quality_report(documents).where("kept").collect()}
    assert set(ids["quality rules"]) == verdict
    texts = Counter((r.text or "").translate(FOLD) for r in seen["quality rules"].collect())
    assert len(ids["exact dedup"]) == len(texts)
    rest = seen["exact dedup"].collect()
    groups = groups_of(len(rest), links([shingles(r.text) for r in rest]))
    assert len(ids["n-gram Jaccard join"]) == len(set(groups))
    assert set(ids["source mixing"]) <= set(ids["n-gram Jaccard join"])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter(ids["source mixing"])
    assert corpus_pipeline.run(spark, SMALL).count() == len(pieces)
    nothing = corpus_pipeline.STAGES[0][1](spark, documents.where("false"), SMALL)
    for _, stage in corpus_pipeline.STAGES[1:]:
        nothing = stage(spark, nothing, SMALL)
    assert nothing.isEmpty()
