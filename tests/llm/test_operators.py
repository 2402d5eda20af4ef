"""Each operator against brute force, and on nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitrina.llm import (
    bpe,
    components,
    divergence,
    exact_dedup,
    html_extract,
    importance,
    line_dedup,
    mixing,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
)

RANKS, FILE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, key string, shard int"
LONG = "word " * 30_000
TEXTS = [None, "", " ", "a", "Ab C\nd", "aB c\nd", "x y z w", "x y z w", "tab\tand\nline\n\nline", "é ñ 中文 😀", LONG]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, three times over, with null and repeated ids and columns that clash with result names."""
    rows = [(i if i % 7 else None, text, "en", f"s{i % 3}" if i % 5 else None, 1, "l", "k", 9) for i, text in enumerate(TEXTS * 3)]
    return spark.createDataFrame(rows + rows[3:6], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")


def _operators(labels):
    return {
        "lines": lambda d: line_dedup.line_dedup(d),
        "quality": lambda d: quality_classifier.scores(d, labels),
        "rules": lambda d: quality_rules.quality_rules(d),
        "mix": lambda d: mixing.mix(d),
        "simhash": lambda d: simhash.near_duplicates(d),
        "shards": lambda d: sharding.shards(d),
        "bpe": lambda d: bpe.bpe(d, RANKS, public_tokenizers.PATTERN),
        "exact": lambda d: exact_dedup.classes(d),
        "counts": lambda d: token_counts.token_counts(d, FILE),
        "suffixes": lambda d: suffix_dedup.dedup(d),
        "importance": lambda d: importance.resample(d, d),
    }


NAMES = ["lines", "quality", "rules", "mix", "simhash", "shards", "bpe", "exact", "counts", "suffixes", "importance"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_document_and_none_for_an_empty_table(name, docs, empty, labels):
    run = _operators(labels)[name]
    found = run(docs).collect()
    assert Counter(row.doc_id for row in found) == Counter(row.doc_id for row in docs.select("doc_id").collect())
    assert run(empty).count() == 0


def test_stages_keep_the_columns(docs, empty, labels):
    for stage in (exact_dedup.dedup, simhash.near_dedup, mixing.mixed, lambda d: quality_classifier.accepted(d, labels)):
        assert stage(docs).schema.names == docs.columns
        assert stage(empty).count() == 0


INTERNAL = (
    "spans top key row rank node band first turn draw shard size docs id hash text fp root u v anchor group_size kept name "
    "label digest at begin end n word source_size target rounds a b c shards quota blocks score predicted held_out of_root"
).split()


def test_stages_survive_any_column_name(spark, labels):
    """Input columns named like the inner columns of the operators come back as they are."""
    extra = [name for name in INTERNAL if name != "text"]
    columns = ", ".join(f"{name} string" for name in extra)
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {columns}"
    rows = [(i, text, "en", "s", 1, *(f"{name}-{i}" for name in extra)) for i, text in enumerate(TEXTS[:-1])]
    frame = spark.createDataFrame(rows, schema)
    given = {row.doc_id: row.asDict() for row in frame.collect()}
    stages = [exact_dedup.dedup, simhash.near_dedup, mixing.mixed, lambda d: quality_classifier.accepted(d, labels)]
    for stage in stages:
        found = stage(frame)
        assert found.schema.names == frame.columns
        for row in found.collect():
            assert all(row[name] == given[row.doc_id][name] for name in extra)
        assert stage(frame.limit(0)).count() == 0
    for run in [suffix_dedup.dedup, lambda d: importance.resample(d, d)]:
        assert run(frame).count() == frame.count()
    # Two sources, so that there is a pair each way.
    two = frame.unionByName(frame.limit(1).withColumn("source", F.lit("t")))
    assert divergence.audit(two).where("part = 'pair'").count() == 2


def test_lines_leave_when_enough_sites_share_them(spark):
    rows = [(i, f"own {i}\n Menu\nrare", f"s{i}") for i in range(6)] + [(9, None, None), (10, "", "s1"), (11, "menu", "s1")]
    rows += [(i, "twice", "s1") for i in range(20, 30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {row.doc_id: row for row in line_dedup.line_dedup(frame, min_sites=6).collect()}
    assert found[2].text == "own 2" and found[2].n_removed == 2 and found[2].n_lines == 3
    assert found[9].text is None and found[10].text == "" and found[11].text == "" and found[20].text == "twice"
    assert line_dedup.line_dedup(frame, min_sites=7).where("n_removed > 0").count() == 0


def test_classifier_separates_and_ignores_the_held_out(spark):
    good = "the quick brown fox jumps over a lazy dog near {} and then it sleeps under some {} trees"
    bad = "spam{0}$$$ buy{0}### now{0}&&& spam{0}$$$ buy{0}### now{0}&&&"
    rows = [(i, (good if i % 3 else bad).format(i * 7919 % 101, i % 13)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    truth = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(400)], "doc_id long, quality int")
    found = quality_classifier.scores(frame, truth).collect()
    held = [row for row in found if row.held_out]
    assert {row.doc_id for row in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(row.predicted == int(row.doc_id % 3 > 0) for row in held) >= 0.95 * len(held)
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3) for row in found)
    # Wrong labels of held-out rows change nothing.
    wrong = truth.selectExpr("doc_id", "case when pmod(crc32(cast(doc_id as string)), 5) = 0 then 1 - quality else quality end as quality")
    again = {row.doc_id: row.score for row in quality_classifier.scores(frame, wrong).collect()}
    assert all(abs(again[row.doc_id] - row.score) < 1e-9 for row in found)


def _brute_base(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), len("".join(words)), symbols, len(lines) - len(set(lines)), len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t#é", max_size=60))
def test_base_counts(text):
    assert quality_rules.base_counts(text.encode()) == _brute_base(text)


def test_common_lines_deplete_documents(spark):
    own = " ".join(f"w{i}" for i in range(60))
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(i, f"{own} {i}\n{shared}", "h") for i in range(12)] + [(i, f"{shared}\nshort {i}", "h") for i in range(20, 32)]
    rows += [(40, shared, "other"), (40, shared, "other"), (41, None, "h")]
    found = {row.doc_id: row for row in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert found[1].kept and found[1].n_left_words == 61
    assert not found[21].kept and not found[21].base_failed and found[21].n_left_words == 2
    assert found[40].kept and found[41].base_failed and not found[41].kept


def test_extraction(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><script>var a = '<p>no</p>';</script></head><body><nav><ul><li><a href=/>Home</a>"
        "</ul></nav><!-- <p>no</p> --><div class=ad>Buy this now</div><article><h1>Head &amp; tail</h1><p>One <b>bold\n word</b>.<br>"
        "<p>&lt;two&gt; &#233;</article><div class='comments'><p>A reader writes quite a long comment here, as readers do.</p></div>"
        "<form><p>Send us your mail address</p></form><footer>&copy; Us</footer></body></html>"
    )
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (None, "u", "", "x"), (4, "u", "<p", "x"), (4, "u", "<p", "x")]
    found = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert found[0].text == "Head & tail\nOne bold word.\n<two> é" and found[0].n_chars == len(found[0].text)
    assert [row.text for row in found[1:]] == ["", "", "", ""]


PROSE = "A long article sentence with quite many words in it, so that nobody could take it for a menu, number {}."


def test_articles_are_not_lost():
    one, two = PROSE.format("one"), PROSE.format("two")
    both = f"{one}\n{two}"
    text = html_extract.main_text
    assert text(f"<div class='layout has-sidebar'><article><p>{one}</p><p>{two}</p></article></div>") == both
    assert text(f"<div class=sidebar-wrap><article><p>{one}<p>{two}</article></div>") == both
    assert text(f"<article><p>{one}</p><button>Buy<p>{two}</p></article>").endswith(two)
    assert text(f"<article><p>{one}</p><svg><path d=1><p>{two}</p></article>").endswith(two)
    assert text(f"<article><p>{one}<ul><li class=comment><p>{two}</p><li>{two}</ul></article>") == both
    assert text(f"<article><p>{one}<p class='ad notice'>{two}<p>{two}</article>") == both
    # What is an aside by its own role stays one, whatever stands in it.
    assert text(f"<article><p>{one}</article><div class=comments><article><p>{two}</article></div>") == one
    assert text(f"<article><p>{one}</article><aside><article><p>{two}</article></aside>") == one
    assert text(f"<article><p>{one}<script>{two}") == one


def test_extraction_takes_linear_time():
    import time

    for piece in ("<head>", "<button>", "</div>", "<li class=comment><p>", "<div class=ad>", "<!--", "<a href='"):
        took = []
        for n in (5_000, 40_000):
            start = time.perf_counter()
            html_extract.main_text(piece * n)
            took.append(time.perf_counter() - start)
        assert took[1] < 24 * took[0] + 0.5


def test_extraction_of_empty_tables_and_long_pages(spark):
    schema = "page_id long, url string, html string"
    assert html_extract.extract(spark.createDataFrame([], schema)).count() == 0
    page = "<article>" + "".join(f"<p>{PROSE.format(i)}" for i in range(20_000)) + "</article>"
    (row,) = html_extract.extract(spark.createDataFrame([(1, "u", page)], schema)).collect()
    assert row.text == "\n".join(PROSE.format(i) for i in range(20_000)) and row.n_chars == len(row.text)


def test_small_corpora_meet_their_targets(spark):
    frame = spark.createDataFrame([(1, "a b c", "x"), (2, "d e f", "y"), (3, None, "z")], "doc_id long, text string, source string")
    found = mixing.mix(frame).collect()
    assert sum(row.taken for row in found) == 6
    assert all(abs(row.taken - row.target) <= 1 for row in found)


def test_any_number_of_sources(spark):
    frame = spark.range(30_000).selectExpr("id as doc_id", "'one two three' as text", "concat('host', id % 15000) as source")
    totals = mixing.mix(frame).groupBy("source_size").agg({"taken": "sum", "target": "max"}).collect()
    assert len(totals) == 1 and totals[0]["sum(taken)"] == 90_000


def test_mixture_meets_its_targets(spark):
    rows = [(i, "w " * (5 + i % 40), f"s{i % 4}" if i % 4 or i < 40 else None) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    found = mixing.mix(frame).collect()
    assert sorted(found) == sorted(mixing.mix(frame.repartition(3)).collect())
    taken, target = Counter(), {}
    for row in found:
        assert 0 <= row.taken <= 3 * row.size
        taken[row.source_size] += row.taken
        target[row.source_size] = row.target
    assert abs(sum(target.values()) - sum(row.size for row in found)) < 1e-6
    assert all(target[s] <= 3 * s + 1e-6 and abs(taken[s] - target[s]) <= 0.03 * target[s] + 16 for s in target)
    words = mixing.mixed(frame).selectExpr("doc_id", "size(split(trim(text), ' ')) as n").collect()
    by_doc = Counter()
    for row in words:
        by_doc[row.doc_id] += row.n
    assert by_doc == Counter({row.doc_id: row.taken for row in found if row.taken})


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=6), st.integers(0, 60))
def test_sainte_lague(spark, claims, blocks):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(list(enumerate(claims)), "party int, claim long")
    found = {row.party: row.quota for row in mixing.sainte_lague(frame, [], "party", "claim", F.lit(blocks)).collect()}
    seats = [0] * len(claims)
    for _ in range(blocks if any(claims) else 0):
        best = max(range(len(claims)), key=lambda i: (claims[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    assert [found[i] for i in range(len(claims))] == seats


def _brute_print(text: str) -> int:
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBc é\n", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == _brute_print(text)


def test_links_find_all_pairs_within_two_bits(spark):
    import random

    draw = random.Random(5)
    prints = [draw.getrandbits(64) for _ in range(40)]
    for _ in range(300):
        value = draw.choice(prints)
        for bit in draw.sample(range(64), draw.choice([1, 2, 2, 3])):
            value ^= 1 << bit
        prints.append(value)
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    found = {row.node: row.root for row in components.components(edges).collect()}
    root = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    assert {p: found.get(p, p) for p in prints} == root


def test_anchors_are_needed(spark):
    import numpy as np

    draw = random.Random(9)
    base = [draw.getrandbits(64) for _ in range(300)]
    pairs = [(b, b ^ sum(1 << bit for bit in draw.sample(range(64), 2))) for b in base]
    steps = simhash.flips(1)

    def found(anchors_of) -> set:
        rows = {(int(anchor), p) for pair in pairs for p in pair for anchor in anchors_of(p)}
        anchors, prints = np.array(sorted(rows), dtype=np.uint64).T
        return set(zip(*(x.tolist() for x in simhash.meetings(anchors, prints, steps)), strict=True))

    expected = {(max(pair), min(pair)) for pair in pairs}
    reach = found(lambda p: simhash.around(np.array([p], dtype=np.uint64), steps)[1][0])
    own = found(lambda p: simhash.around(np.array([p], dtype=np.uint64), simhash.flips(0))[1][0])
    assert reach == expected and own < expected and len(own) < 0.7 * len(expected)


def test_crowded_anchors_give_the_same_components(spark):
    draw = random.Random(4)
    centre = draw.getrandbits(62)
    prints = sorted({centre ^ sum(1 << bit for bit in draw.sample(range(62), draw.randrange(5))) for _ in range(400)})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    whole = {row.node: row.root for row in components.components(simhash.links(frame)).collect()}
    dealt = {row.node: row.root for row in components.components(simhash.links(frame, crowd=3)).collect()}
    assert whole == dealt and len(set(whole.values())) < len(whole)
    wide = {row.node: row.root for row in components.components(simhash.links(frame, distance=4)).collect()}
    root = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 4 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    assert {p: wide.get(p, p) for p in prints} == root
    with pytest.raises(ValueError):
        simhash.links(frame, distance=3)


def test_near_stage_keeps_one_of_each_component(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base), (3, base), (9, base.upper()), (7, "other words here"), (8, None), (2, ""), (None, "a b"), (None, "a b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near(spark, frame, "").collect()
    assert Counter(row.doc_id for row in kept) == Counter([3, 7, 2, None])


def test_jump_hash_and_slots(spark):
    def jump(key, n):
        bucket, after = -1, 0
        while after < n:
            bucket = after
            key = (key * 2862933555777941757 + 1) % 2**64
            after = int((bucket + 1) * (2**31 / ((key >> 33) + 1)))
        return bucket

    ids = [0, 1, -1, 2**63 - 1, -(2**63), *range(100, 600), 100, 100]
    rows = [(i, None if i == 100 else "é" * (i % 5)) for i in ids]
    found = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    slots = defaultdict(list)
    for row in found:
        assert (row.shard, row.grown_shard) == (jump(row.doc_id % 2**64, 40), jump(row.doc_id % 2**64, 41))
        assert row.grown_shard in (row.shard, 40)
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


PARTS = ["a", "b", " ", "\n", "'s", "'", "1", "é", "!", "<|endoftext|>", "\x1c", "\x85", "中", "the"]
ODD = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_bpe_is_exact_and_reversible(text):
    known = bpe.codec(RANKS, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(), special_tokens={})
    (ids,) = known.encode([text])
    assert ids.tolist() == own.encode_ordinary(text)
    assert bpe.decode(ids.tolist(), known.table) == text.encode()


def test_new_units_are_searched_and_encoded_in_one_go(monkeypatch):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(), special_tokens={})
    known = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    searched, pattern = [], known.pattern

    class Searching:
        def findall(self, text):
            searched.append(text)
            return pattern.findall(text)

    monkeypatch.setattr(known, "pattern", Searching())
    group = ["one, two's (three) 4th!", "caf\u00e9 \U0001f600\u00e9 end. ", " x\ny", "", " ", "five  six"]
    for _ in range(2):
        assert [ids.tolist() for ids in known.encode(group, remembered=3)] == [own.encode_ordinary(text) for text in group]
    # Only a text's first unit and those that end in white space are searched alone.
    assert len(searched) < len(set().union(*map(bpe.units, group)))
    # A pattern that leaves out characters is searched unit by unit.
    partial = bpe.Codec(RANKS, "[a-z]+")
    (ids,) = partial.encode(["one, two three4"])
    assert bpe.decode(ids.tolist(), partial.table) == b"onetwothree"


def test_token_offsets(spark):
    rows = [(1, "Ab \u4e2d\u6587\U0001f600 caf\u00e9!"), (2, ""), (3, None), (4, "\U0001f9d1\u200d\U0001f680" * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {row.doc_id: row for row in bpe.bpe(frame, RANKS, public_tokenizers.PATTERN, offsets=True).collect()}
    table = bpe.codec(RANKS, public_tokenizers.PATTERN).table
    split = False
    for doc_id, text in rows:
        row, raw = found[doc_id], (text or "").encode()
        where = [len(raw[:i].decode("utf-8", "ignore")) for i in range(len(raw) + 1)]
        assert row.byte_begins == [0, *row.byte_ends][: len(row.ids)] and (row.byte_ends or [0])[-1] == len(raw)
        for i, begin, end, low, high in zip(row.ids, row.byte_begins, row.byte_ends, row.char_begins, row.char_ends, strict=True):
            assert raw[begin:end] == table[i] and low == where[begin] and raw[begin:end] in text[low:high].encode()
            split |= raw[begin:end] != text[low:high].encode()
    assert split


_cache: dict = {}


def _ranks():
    return _cache.setdefault("ranks", bpe.read_ranks(RANKS))


def test_remembered_white_space_does_not_change_the_cut():
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(), special_tokens={})
    library = Tokenizer.from_file(FILE)
    known, counter = bpe.Codec(RANKS, public_tokenizers.PATTERN), token_counts.TokenCounter(FILE)
    for space in [" ", "\u00a0", "\n", "\u3000"]:
        known.known, counter.known = {}, {}
        for text in [f"word {space}", "word ", f"a{f' {space}' * 4} b", f"a{f' {space}' * 8} b", "a    b", f"a {space}b"]:
            (ids,) = known.encode([text])
            assert ids.tolist() == own.encode_ordinary(text)
            assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(ODD, st.integers(1, 9))
def test_transducer_counts_what_the_library_counts(text, chunk):
    library = _cache.setdefault("library", Tokenizer.from_file(FILE))
    expected = len(library.encode(text, add_special_tokens=False).ids)
    counter = token_counts.counter(FILE)
    maps = [counter.summary(text[i : i + chunk]) for i in range(0, len(text), chunk)] or [counter.summary("")]
    whole = counter.scan(maps)
    assert counter.count(text) == expected
    assert counter.total(whole.head) + whole.count + counter.total(whole.tail or "") == expected


def test_exact_groups_with_a_heavy_hitter(spark):
    rows = [(i, "Hot" if i % 3 else f"t{i % 40}") for i in range(3000)] + [(7, "hot"), (7, "HOT"), (None, "alone"), (None, None), (5000, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = exact_dedup.classes(frame, k=4).collect()
    groups = defaultdict(list)
    for id_, text in rows:
        groups[hashlib.sha256((text or "").lower().encode()).hexdigest()].append(id_)
    assert len(found) == len(rows)
    for row in found:
        group = groups[row.text_sha256]
        assert row.group_size == len(group) and row.keep_id == max((i for i in group if i is not None), default=None)
    assert Counter(row.text_sha256 for row in found if row.kept) == Counter(list(groups))
    assert exact_dedup.dedup(frame, k=4).count() == len(groups)
    keys = frame.selectExpr("cast(lower(coalesce(text, '')) as binary) as key")
    assert [bytes(row.key) for row in exact_dedup.frequent(keys, 4).collect()] == [b"hot"]


def _brute_removed(rows: list[tuple], length: int) -> dict:
    """n_bytes, n_removed, n_spans, kept of each row; a place is (no id, id, start)."""
    first: dict[bytes, tuple] = {}
    for id_, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            place = (id_ is None, id_ or 0, i)
            first[raw[i : i + length]] = min(first.get(raw[i : i + length], place), place)
    found = []
    for id_, text in rows:
        raw = (text or "").encode()
        marked = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if (id_ is None, id_ or 0, i) > first[raw[i : i + length]]:
                marked[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(raw)) if marked[i] and not (i and marked[i - 1]))
        found.append((id_, len(raw), sum(marked), spans, bytes(c for c, m in zip(raw, marked, strict=True) if not m)))
    return Counter(found)


@pytest.mark.parametrize("crowd, block, level", [(8192, 1 << 20, None), (2, 64, None), (1, 1, None)])
def test_repeated_strings_leave(spark, crowd, block, level):
    draw = random.Random(crowd)
    phrases = ["".join(draw.choice("abc \u00e9") for _ in range(draw.choice([5, 20, 45]))) for _ in range(12)]
    rows = [(i if i % 9 else None, "".join(draw.choice(phrases) for _ in range(draw.randrange(12)))) for i in range(60)]
    rows += [(61, "a" * 400), (62, "b" + "a" * 300), (63, "ab" * 150), (64, ""), (65, None), (66, "\0" * 80), (66, "x" + "\0" * 70)]
    rows += rows[2:5] + [(70, LONG[:20_000])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix_dedup.dedup(frame, length=20, crowd=crowd, block=block).collect()
    plain = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)
    assert plain == _brute_removed(rows, 20)
    assert all(r.n_removed == sum(s.end - s.begin for s in r.spans) and r.n_spans == len(r.spans) for r in found)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=120).map(lambda b: bytes(x % 3 * 97 for x in b)), st.integers(1, 30))
def test_suffixes_are_sorted_and_prefixes_counted(raw, depth):
    import numpy as np

    text = np.frombuffer(raw, dtype=np.uint8)
    order = suffix_dedup.suffix_order(text, depth).tolist()
    heads = [(raw[i:] + bytes(depth))[:depth] for i in order]
    assert sorted(order) == list(range(len(raw))) and heads == sorted(heads)
    shared = suffix_dedup.common_prefixes(text, np.array(order, dtype=np.int64), depth).tolist()
    for i in range(1, len(order)):
        same = next((k for k in range(depth) if heads[i][k] != heads[i - 1][k]), depth)
        assert shared[i] == same


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=300), min_size=1, max_size=8))
def test_position_table_gives_crc32(parts):
    import numpy as np

    sizes = np.array([len(p) for p in parts])
    end = np.cumsum(sizes + 1) - 1
    buffer = np.frombuffer(b"\xff".join(parts), dtype=np.uint8)
    found = importance.checksums(buffer, end - sizes, end)
    assert found.tolist() == [zlib.crc32(p) for p in parts]


def test_features_of_long_texts_are_cut_without_loss(spark, monkeypatch):
    import pyarrow as pa

    text = " ".join(f"w{i % 50}\u00e9" for i in range(400)) + " " + "z" * 300 + " end"
    batch = pa.RecordBatch.from_pydict({"text": ["One  two", None, text, "three"]})
    whole = Counter((n, int(r), int(c)) for n, row, crc in importance.features(batch, 3) for r, c in zip(row, crc, strict=True))
    monkeypatch.setattr(importance, "PART", 64)
    parts = Counter((n, int(r), int(c)) for n, row, crc in importance.features(batch, 3) for r, c in zip(row, crc, strict=True))
    assert whole == parts
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    assert Counter(c for n, r, c in whole.elements() if r == 2 and n == 2) == Counter(
        zlib.crc32(" ".join(words[i : i + 2]).encode()) for i in range(len(words) - 1)
    )


def test_importance_of_odd_rows(spark):
    rows = [(1, "a b " * 20), (1, "a b " * 20), (None, "a b " * 20), (2, None), (3, ""), (4, "c d " * 20), (5, "rare " * 19)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = importance.resample(frame, frame.where("doc_id = 4"), share=100).collect()
    ranks = sorted(row.rank for row in found if row.rank is not None)
    assert ranks == [1, 2, 3, 4] and all(row.rank is None and row.n_features in (0, 37) for row in found if row.doc_id in (2, 3, 5))
    assert {row.weight > 0 for row in found if row.doc_id == 4} == {True}
    ordered = sorted((row for row in found if row.rank), key=lambda row: row.rank)
    assert [row.score for row in ordered] == sorted((row.score for row in ordered), reverse=True)
    assert importance.resample(frame, frame.limit(0)).count() == len(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6)), max_size=60), st.integers(1, 5))
def test_skyband_keeps_what_few_dominate(rows, top):
    import numpy as np

    n, lang_n = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(2))
    expected = [
        i for i, (a, b) in enumerate(rows) if sum(1 for c, d in rows[:i] if c >= a and d <= b) < top
    ]
    assert divergence.undominated(n, lang_n, top).tolist() == expected


def _brute_audit(rows: list[tuple], min_docs: int, top: int) -> set:
    docs = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))) for text, lang, source in rows]
    found = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(term for d in mine for term in d[2])
        kept = sorted(t for t in held if held[t] >= min_docs)
        counts = {g: Counter() for g in {d[1] for d in mine}}
        for _, source, words in mine:
            counts[source].update({t: n for t, n in words.items() if held[t] >= min_docs})
        total = sum(counts.values(), Counter())

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}

        p, q = {g: shares(c) for g, c in counts.items()}, shares(total)
        for g in counts:
            pairs = [(sum((p[g][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != g]
            terms = [((p[g][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[g][t] and p[g][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                found |= {(lang, g, part, item, value, i + 1) for i, (value, item) in enumerate(ranked) if part == "pair" or i < top}
    return found


def test_divergence_equals_brute_force(spark, monkeypatch):
    draw = random.Random(2)
    vocabulary = [f"{a}{b}\u00e9" for a in "abcdeXY" for b in "fghij"]
    rows = [
        (" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(40))), draw.choice(["en", "de", None]), f"s{draw.randrange(9)}")
        for _ in range(90)
    ]
    rows += [(None, "fr", "x"), ("", "fr", None), ("solo", "it", "y"), *rows[:3]]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    expected = _brute_audit(rows, 3, 5)
    for side, width in ((64, 2048), (2, 7)):
        found = divergence.audit(frame, top=5, side=side, width=width).collect()
        assert {tuple(row) for row in found} == expected and len(found) == len(expected)
    assert divergence.audit(frame.limit(0)).count() == 0
