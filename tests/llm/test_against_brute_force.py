"""Operators against plain statements of what they compute, on the smallest documents."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import bpe, bradley_terry, chat, common, host_rules, media, mixing, paragraphs, queries, simhash, suffix, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text or "", r.source) for r in common.documents(spark, SF).collect()]


# -- suffix arrays --
fragments = st.lists(st.binary(min_size=1, max_size=30).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(fragments)
def test_suffix_array_and_common_prefixes(parts):
    raw = b"".join(parts)
    sizes = np.array([len(p) for p in parts])
    stops = np.cumsum(sizes)
    ends = np.repeat(stops, sizes)
    sa, rank = suffix.suffix_array(np.frombuffer(raw, np.uint8), ends)
    assert sa.tolist() == sorted(range(len(raw)), key=lambda i: (raw[i : ends[i]], i))
    lcp = suffix.common_prefixes(np.frombuffer(raw, np.uint8), stops - sizes, ends, sa, rank)
    for k in range(1, len(sa)):
        a, b = raw[sa[k - 1] : ends[sa[k - 1]]], raw[sa[k] : ends[sa[k]]]
        assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_blocks_are_merged_by_binary_search():
    random.seed(5)
    base = [bytes(random.choice(b"ab") for _ in range(160)) for _ in range(6)]
    parts = sorted({bytes(random.choice(base)[: random.randint(100, 160)]) for _ in range(40)}, key=lambda _: random.random())
    anchor = np.zeros(len(parts), np.int64)
    seen, expected = set(), set()
    for i, p in enumerate(parts):
        for s in range(len(p) - 99):
            (expected if p[s : s + 100] in seen else seen).add((i, s) if p[s : s + 100] in seen else p[s : s + 100])
    for block in (300, 1000, 1 << 20):
        found = {(i, s + k) for i, s, n in suffix.repeated_windows(parts, anchor, block) for k in range(n)}
        assert found == expected


def removed(rows):
    seen, out = set(), {}
    for i, text, _ in sorted(rows):
        b = text.encode()
        cover = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                cover[p : p + 100] = b"\1" * 100
            else:
                seen.add(w)
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out[i] = (len(b), sum(cover), sum(c and not (k and cover[k - 1]) for k, c in enumerate(cover)), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [suffix.HOT, 2])
def test_suffix_dedup(spark, rows, hot):
    found = {r[0]: tuple(r)[1:] for r in suffix.deduplicate(common.documents(spark, SF), hot=hot).collect()}
    assert found == removed(rows)


# -- SimHash --
def plain_fingerprint(text):
    words = [w for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, rows):
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6_simhash(spark, SF).collect()}
    prints = {i: plain_fingerprint(t) for i, t, _ in rows}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert found == {i: (f"{prints[i]:016x}", find(i)) for i in ids}


def test_links_of_chains_and_crowds(spark):
    random.seed(1)
    values = {0, 1, 3, 7, 15, 31, 1 << 63, (1 << 63) | 3} | {1 << k for k in range(20)} | {random.getrandbits(64) for _ in range(50)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    for radius in (1, 2):
        edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius)
        found = dict(simhash.components(edges).collect())
        group = {v: v for v in signed}
        changed = True
        while changed:
            changed = False
            for a in signed:
                for b in signed:
                    if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= radius and group[b] < group[a]:
                        group[a], changed = group[b], True
        assert all(found.get(v, v) == group[v] for v in signed)


# -- BPE --
@pytest.fixture(scope="module")
def tokenizers_pair():
    from tokenizers import Tokenizer

    return bpe.Automaton.load(), Tokenizer.from_file(bpe.default_path())


pieces = st.lists(st.one_of(st.text(max_size=6), st.sampled_from([" ", "  ", "\n", " \n", "'s", "<|endoftext|>", "\x1c", " a", "123", "the", "."])), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(pieces)
def test_bpe_equals_the_library(tokenizers_pair, text):
    automaton, library = tokenizers_pair
    ids = automaton.encode(text)
    expected = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == expected
    assert automaton.decode(ids).decode() == library.decode(expected, skip_special_tokens=False)


def test_bpe_query(spark, rows, tokenizers_pair):
    library = tokenizers_pair[1]
    for r in queries.op5_bpe(spark, SF).collect():
        text = next(t for i, t, _ in rows if i == r.doc_id)
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_tables(spark):
    docs = spark.createDataFrame([(1, "Hello  world é"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs)).collect()} == {1: "Hello  world é", 2: ""}


# -- chat --
hostile = st.lists(st.one_of(st.text(max_size=5), st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "\n", "<\\", "|turn|>"])), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(hostile)
def test_guard_is_reversible_and_complete(text):
    assert chat.unguard(chat.guard(text)) == text and chat.unline(chat.line(text)) == text
    assert not any(c in chat.guard(text) for c in chat.CONTROLS) and "\n" not in chat.line(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), hostile), hostile), max_size=5))
def test_turns_are_read_back(turns):
    out = list(chat.read_turns(chat.Template().render([{"role": r, "text": t} for r, t in turns])))
    assert [(r, t) for r, t, _, _ in out] == turns
    assert [u for _, _, u, _ in out] == [t if r == "assistant" else "" for r, t in turns]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), hostile), hostile), max_size=6), st.integers(1, 40))
def test_output_is_read_back_in_any_pieces(turns, size):
    render = lambda: chat.Template().render([{"role": r, "text": t} for r, t in turns])
    expected = [(r, t, t if r == "assistant" else "") for r, t in turns]
    assert [x[:3] for x in chat.read_output(chat.output(render(), size))] == expected
    pieces = list(chat.output(render(), size))
    formatted, spans = "".join(p for p, _ in pieces), [x for _, m in pieces for x in m]
    assert formatted == "".join(t for t, _ in render())
    assert [x[:3] for x in chat.read_formatted(formatted, spans)] == expected
    assert sum(x[3] for x in chat.read_formatted(formatted, spans)) == len(formatted)


def test_chat_query_equals_the_written_output(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    digests = {r.conv_id: r for r in queries.op7_chat(spark, SF).collect()}
    for r in chat.format_conversations(rows).collect():
        turns = list(chat.read_formatted(r.formatted, [(x.start, x.end) for x in r.loss]))
        d = digests[r.conv_id]
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b, _, _ in turns).encode()).hexdigest()
        loss = "".join(x for _, _, x, _ in turns)
        assert (d.n_turns, d.loss_chars, d.loss_sha256, d.formatted_chars) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(r.formatted))


def test_template_language():
    render = lambda s, **n: "".join(t for t, _ in chat.Template(s).render(n.pop("messages", []), **n))
    assert render("{{ 'a' + 'b' }}{# no #}{% if 1 == 2 %}x{% elif true and not false %}y{% else %}z{% endif %}") == "aby"
    assert render("{% for m in messages %}{{ loop.index }}{{ m['t'] }}{% if not loop.last %},{% endif %}{% endfor %}", messages=[{"t": 1}, {"t": 2}]) == "11,22"
    assert chat.fold(chat.parse("a{{ 'b' | upper }}{% if false %}c{% endif %}d"))[1] == [("out", ("const", "aBd"))]
    for bad in ("{{ x.__class__ }}", "{{ open('f') }}", "{% for x %}", "{{ _x }}", "{% if 1 %}", "{{ x | eval }}", "{% import os %}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)


# -- mixing --
@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), min_size=1, max_size=5), st.integers(0, 80))
def test_knapsack_is_optimal(counts, budget):
    lengths, numbers = np.array(sorted(counts)), np.array([counts[k] for k in sorted(counts)])
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    take = mixing.knapsack(lengths, numbers, budget)
    assert (take <= numbers).all() and abs(int((take * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)
    near = mixing.fit(lengths, numbers, budget)
    assert (near <= numbers).all() and abs(int((near * lengths).sum()) - min(budget, int((lengths * numbers).sum()))) <= max(counts)


def test_long_documents_beyond_the_width():
    lengths, counts = np.array([100_000]), np.array([10])
    assert mixing.fit(lengths, counts, 290_000).tolist() == [3] and mixing.fit(lengths, counts, 240_000).tolist() == [2]
    assert mixing.fit(np.array([70_000, 90_000]), np.array([1, 5]), 80_001).tolist() in ([0, 1], [1, 0])


def test_repeated_rows_are_taken_as_often_as_the_mix_says(spark):
    text = lambda n: " ".join(["w"] * n)
    rows = [(1, text(7), "a", "x"), (1, text(7), "a", "y"), (1, text(7), "a", "z"), (1, text(5), "a", "x"), (2, text(40), "b", "x"), (3, text(9), None, "x"), (3, text(9), None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other string")
    words = sum(r.taken for r in mixing.mix(docs).collect())
    for _ in range(2):
        taken = mixing.take(docs).collect()
        assert sum(len(r.text.split()) for r in taken) == words and set(map(tuple, taken)) <= set(rows)
    assert sorted(map(str, taken)) == sorted(map(str, mixing.take(docs.repartition(5)).collect()))


def test_targets():
    assert mixing.capped_targets([("a", 10), ("b", 10), ("c", 10)]) == [5.0, 10.0, 15.0]
    assert mixing.capped_targets([("a", 100), ("b", 1), ("c", 1)]) == [96.0, 3.0, 3.0]
    assert mixing.capped_targets([("a", 0), ("b", 5)]) == [0.0, 5.0] and mixing.capped_targets([]) == []


def test_mixing(spark, rows):
    found = {r.doc_id: r for r in queries.op8_mixing(spark, SF).collect()}
    size = {i: len(WORD.findall(t)) for i, t, _ in rows}
    by = defaultdict(list)
    for i, _, s in rows:
        by[s].append(i)
        assert found[i].size == size[i] and found[i].taken <= 3 * size[i] and (size[i] == 0 or found[i].taken % size[i] == 0)
    for ids in by.values():
        assert {found[i].source_size for i in ids} == {sum(size[i] for i in ids)}
        # the nearest sum that whole copies and a choice of documents can have
        target, whole = found[ids[0]].target, sum(size[i] for i in ids)
        copies = min(3, int(target // whole)) if whole else 0
        sums = {0}
        for i in ids if copies < 3 else ():
            sums |= {x + size[i] for x in sums}
        nearest = min((abs(copies * whole + x - target) for x in sums), default=0)
        assert abs(sum(found[i].taken for i in ids) - target) <= nearest + 1
    assert {r.doc_id: r.taken for r in queries.op8_mixing(spark, SF).collect()} == {i: r.taken for i, r in found.items()}


# -- media --
def test_media(spark, rows):
    for r in queries.op9_media(spark, SF).collect():
        b = next(t for i, t, _ in rows if i == r.doc_id).encode()
        payload = b.ljust(max(1, -(-len(b) // 64)) * 64, b"\0")
        stored = media.encode_png(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest()) and re.fullmatch("[0-9a-f]{16}", r.feature)


def test_all_filters_are_undone():
    rng = np.random.default_rng(3)
    image = rng.integers(0, 256, (40, 64), dtype=np.uint8)
    kinds = rng.integers(0, 5, 40).astype(np.uint8)
    rows = np.zeros_like(image)
    for y in range(40):
        for x in range(64):
            left, up = int(image[y, x - 1]) if x else 0, int(image[y - 1, x]) if y else 0
            corner = int(image[y - 1, x - 1]) if x and y else 0
            p = left + up - corner
            paeth = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
            rows[y, x] = (int(image[y, x]) - (0, left, up, (left + up) // 2, paeth)[kinds[y]]) % 256
    assert (media.unfilter(kinds, rows) == image).all()


def test_damage_is_found():
    good = media.encode_png(bytes(range(64)) * 9)
    assert media.decode_png(good).tobytes() == bytes(range(64)) * 9
    for at in range(0, len(good), 7):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises((media.CorruptImage, struct.error)):
            media.decode_png(bytes(bad))
    with pytest.raises((media.CorruptImage, struct.error)):
        media.decode_png(good[:-5])


def test_cosine_hash_equals_its_statement():
    """Of an image of 32 by 32, where nothing is shrunk: the plain cosine sums (not scaled to unit length) term by term, bits above the median but for the first."""
    image = np.random.default_rng(9).integers(0, 256, (32, 32)).astype(np.uint8)
    low = np.zeros((8, 8))
    for u in range(8):
        for v in range(8):
            low[u, v] = sum(float(image[y, x]) * np.cos(np.pi * u * (2 * y + 1) / 64) * np.cos(np.pi * v * (2 * x + 1) / 64) for y in range(32) for x in range(32))
    flat = low.ravel()
    bits = "".join("1" if x > np.median(flat[1:]) else "0" for x in flat)
    assert media.cosine_hash(image) == f"{int(bits, 2):016x}"


def test_close_images_have_close_hashes():
    image = np.random.default_rng(1).integers(0, 256, (64, 64), dtype=np.uint8)
    other = image.copy()
    other[5, 5] ^= 3
    a, b = (int(media.cosine_hash(x), 16) for x in (image, other))
    assert bin(a ^ b).count("1") <= 4


# -- rules and paragraphs --
def test_measures(rows):
    for _, text, _ in rows:
        words = WORD.findall(text)
        grams = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert host_rules.measure(text.encode()) == expected


def test_host_verdicts(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, "bad", "bad") for i in range(40)] + [(200, good, "bad"), (300, good, None)]
    found = {r.doc_id: r for r in host_rules.apply(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert found[0].kept and not found[100].kept and found[100].base_failed
    assert not found[200].kept and not found[200].base_failed and found[300].kept


def _planted_hosts():
    """Ten hosts of 200 documents; one fails by short texts, one by symbols, one by repeated lines, each in most documents."""
    random.seed(6)
    say = lambda n: " ".join("".join(random.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    made = []
    for i in range(2000):
        host, bad = i % 10, random.random()
        text = say(60)
        if host == 1 and bad < 0.7 or bad > 0.95:
            text = say(20)
        elif host == 2 and bad < 0.6:
            text = "# & # & " * 40 + say(60)
        elif host == 3 and bad < 0.8:
            text = "a line\n" * 8 + say(90)
        elif host == 4 and bad < 0.12:
            text = say(20)
        made.append((i, text, f"h{host}"))
    return made


def test_hosts_are_rejected_by_any_rule(spark):
    import duckdb
    import pandas as pd

    made = _planted_hosts()
    docs = spark.createDataFrame(made, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in host_rules.apply(docs).collect()}
    assert {r.source for r in found.values() if r.host_rejected} == {"h1", "h2", "h3"}
    dropped = [i for i, r in found.items() if not r.base_failed and not r.kept]
    assert len(dropped) > 300 and all(found[i].source in ("h1", "h2", "h3") for i in dropped)
    assert all(r.kept == (not r.base_failed) for r in found.values() if r.source not in ("h1", "h2", "h3"))
    # the statement for SQL, over the same rows
    documents = pd.DataFrame(made, columns=["doc_id", "text", "source"])  # noqa: F841
    plain = duckdb.sql(queries.oracle_sql()["op3_host_rules"]).fetchall()
    assert {r[0]: r[-1] for r in plain} == {i: r.kept for i, r in found.items()}
    # the bound, spelled out for one host and rule
    symbols = lambda t: 10 * len(re.findall(r"[#*$%&|<>]", t)) > sum(map(len, WORD.findall(t)))
    rate = {h: sum(symbols(t) for _, t, s in made if s == h) / 200 for h in {s for _, _, s in made}}
    mean = sum(rate.values()) / 10
    weight = max(1, mean * (1 - mean) / (sum((r - mean) ** 2 for r in rate.values()) / 10) - 1)
    p = (200 * rate["h2"] + mean * weight) / (200 + weight)
    verdict = host_rules.host_verdicts(host_rules.measures(docs, ["source"])).where("host = 'h2'").first()
    assert verdict.rate_symbols == pytest.approx(p) and verdict.lower_symbols == pytest.approx(p - 1.645 * (p * (1 - p) / (201 + weight)) ** 0.5)


def test_paragraphs(spark):
    random.seed(2)
    word = lambda: "".join(random.choice("abcdefg") for _ in range(6))
    passage = [word() for _ in range(60)]
    edited = passage[:30] + ["changed"] + passage[31:]
    far = passage[:25] + [word() for _ in range(35)]
    texts = {1: " ".join(passage), 2: "Intro. " + " ".join(passage), 3: " ".join(edited) + "\nmore", 4: " ".join(far), 5: " ".join(word() for _ in range(60))}
    rows = paragraphs.duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.kept_doc_id, r.removed) for r in rows} == {1: (1, False), 2: (1, True), 3: (1, True)}
    assert paragraphs.recall(0.8, paragraphs.BANDS, paragraphs.ROWS) > 0.99 and paragraphs.tune_bands(0.8, 0.995, 12) == (6, 2)


def test_passages_of_short_sentences(spark):
    random.seed(3)
    word = lambda: "".join(random.choice("abcdefg") for _ in range(6))
    say = lambda n: " ".join(word() for _ in range(n))
    short = " ".join(say(3) + "." for _ in range(20))
    line, far = say(6), say(20)
    edited = far.split()
    edited[10] = "changed"
    texts = {1: short, 2: f"{say(12)}. {short} {say(12)}.", 3: line, 4: f"{say(20)}.\n{line}", 5: f"{far}. {say(60)}.", 6: say(30), 7: "One. Two."}
    texts[8] = texts[5].replace(far, " ".join(edited))  # a sentence at 0.5 in a line above 0.8
    texts[9] = "a b c\nd e f\ng h i\n\nj k l"
    texts[10] = "m n o\n\na b c\nd e\nf g h i"  # a block with other line ends
    rows = paragraphs.duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    gone = {i: {k for r in rows if r.doc_id == i and r.removed for k in range(r.start, r.end)} for i in texts}
    assert {i for i, places in gone.items() if places} == {2, 4, 8, 10}
    for i, passage in ((2, short), (4, line), (8, texts[8]), (10, "a b c\nd e\nf g h i")):
        at = texts[i].index(passage)
        assert gone[i] == set(range(at, at + len(passage)))


def test_a_paragraph_is_no_copy_of_what_overlaps_it(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = paragraphs.duplicates(spark.createDataFrame([(1, f"So. {long}. It is."), (2, f"{long[1:]}. No. {long[1:]}.")], "doc_id long, text string")).collect()
    assert {r.kept_doc_id for r in rows} == {1} and {r.removed for r in rows if r.doc_id == 1} == {False} and {r.removed for r in rows if r.doc_id == 2} == {True}
    alone = [(1, f"So. {long}. It is.")]
    assert paragraphs.duplicates(spark.createDataFrame(alone, "doc_id long, text string")).count() == 0
    assert sorted(r.removed for r in paragraphs.duplicates(spark.createDataFrame(alone * 2, "doc_id long, text string")).collect() if r.start == 0) == [False] * 2 + [True] * 2


def near_lines(texts, similarity=0.8):
    """Pairs of distinct lines of five words and more that similar, from all that share a shingle."""
    lines = sorted({tuple(w) for t in texts for x in t.split("\n") if len(w := WORD.findall(x)) >= 5})
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
    index = {}
    for i, s in enumerate(sets):
        for h in s:
            index.setdefault(h, []).append(i)
    met = {(i, j) for at in index.values() for k, j in enumerate(at) for i in at[:k] if min(len(sets[i]), len(sets[j])) >= similarity * max(len(sets[i]), len(sets[j]))}
    return [(lines[i], lines[j]) for i, j in sorted(met) if paragraphs.jaccard(sets[i], sets[j]) >= similarity]


def test_whole_lines_link(spark):
    docs = common.documents(spark, "/root/testdata/sf0.01")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    component = {}
    for r in paragraphs.duplicates(docs).collect():
        words = tuple(WORD.findall(texts[r.doc_id].encode()[r.start : r.end].decode()))
        component.setdefault(words, r.component_id)
    pairs = near_lines(texts.values())
    found = sum(component.get(a, 1) == component.get(b, 2) for a, b in pairs)
    print(f"{found} of {len(pairs)} near pairs of lines")
    assert len(pairs) > 10 and found >= 0.98 * len(pairs)


@pytest.mark.parametrize(("similarity", "hot"), [(0.5, paragraphs.HOT), (0.6, paragraphs.HOT), (0.6, 3), (0.8, 3)])
def test_edited_paragraphs_link_at_other_similarities(spark, similarity, hot):
    random.seed(8)
    base = [[f"w{random.randrange(10**6)}" for _ in range(60)] for _ in range(12)]
    texts = []
    for i in range(150):
        words = list(base[i % 12])
        for at in random.sample(range(60), random.randint(0, 3)):
            words[at] = f"x{random.randrange(10**6)}"
        texts.append(" ".join(words))
    pairs = near_lines(texts, similarity)
    rows = paragraphs.duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), similarity=similarity, hot=hot).collect()
    whole = {texts[r.doc_id]: r.component_id for r in rows if r.n_words == 60}
    found = sum(whole.get(" ".join(a), 1) == whole.get(" ".join(b), 2) for a, b in pairs)
    assert len(pairs) > 40 and found >= 0.98 * len(pairs)
    root = {t: t for t in texts}
    for a, b in pairs * 3:  # no component joins what no chain of pairs joins
        a, b = root[" ".join(a)], root[" ".join(b)]
        root |= {t: min(a, b) for t in texts if root[t] in (a, b)}
    by = defaultdict(set)
    for t, c in whole.items():
        by[c].add(root[t])
    assert all(len(x) == 1 for x in by.values())


def test_repeated_passages_are_found_whole(spark, rows):
    """Every run of whole sentences of 20 words at least that an earlier document has too goes, and nothing of what never repeats."""
    least = paragraphs.PASSAGE
    found = defaultdict(set)
    for r in queries.op4_paragraphs(spark, SF).collect():
        if r.removed:
            found[r.doc_id] |= set(range(r.start, r.end))
    sentences, first = {}, {}
    for i, text, _ in sorted(rows):
        b, cut, at = text.encode(), [], 0
        for m in re.finditer(rb"(?<=[.!?])[ \t\r\x0b\f]+|\n|\Z", b):
            words = re.findall(rb"[^\x20\x09-\x0D]+", b[at : m.start()])
            if words:
                lead = at + len(b[at : m.start()]) - len(b[at : m.start()].lstrip())
                cut.append((lead, at + len(b[at : m.start()].rstrip()), words))
            at = m.end()
        sentences[i] = cut
    n = 0
    for i in sorted(sentences):
        cut = sentences[i]
        here = []
        for a in range(len(cut)):
            words = []
            for b in range(a, len(cut)):
                words += cut[b][2]
                if len(words) >= least:
                    here.append((tuple(words), a, b))
                    break
        for words, a, b in here:
            if first.setdefault(words, i) != i:
                n += 1
                assert set(range(cut[a][0], cut[b][1])) <= found[i]
    assert n > 50


def test_the_query_compares_short_lines_and_passages(spark, tmp_path):
    line, passage = " ".join(f"l{i}" for i in range(12)), "p0 p1 p2 p3 p4."
    texts = {
        1: f"Home\na b c d\nb c d e f g\n{line}\nq0 q1. {passage} q2\nx x x x x",
        2: "r1 r2 r3\nHome", 3: "a b c d\nr4 r5 r6", 4: f"r7\n{line} more", 5: f"r8 r9. {passage} r10 r11", 6: "x" + " x" * 29, 7: "a b c\nc d e f g\nr12", 8: "r13 \n b  c d e f g",
    }
    goes = {2: "Home", 3: "a b c d", 4: f"{line} more", 5: passage, 6: texts[6], 8: "b  c d e f g"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op4_paragraphs(spark, str(tmp_path)).collect()
    assert {(r.doc_id, texts[r.doc_id][r.start : r.end]) for r in rows if r.removed} == set(goes.items())
    assert {r.kept_doc_id for r in rows} == {1} and {r.doc_id for r in rows if not r.removed} == {1}


def test_every_repeated_line_is_found(spark, rows):
    """Lines of any length that a document before has too, counted by plain statements."""
    gone, lines, first = defaultdict(set), [], {}
    for r in queries.op4_paragraphs(spark, SF).collect():
        if r.removed:
            gone[r.doc_id] |= set(range(r.start, r.end))
    for i, text, _ in sorted(rows):
        at = 0
        for x in text.encode().split(b"\n"):
            if words := tuple(re.findall(rb"[^\x20\x09-\x0D]+", x)):
                lead = at + x.index(words[0])
                lines.append((i, words, lead, lead + len(x.strip())))
                first.setdefault(words, i)
            at += len(x) + 1
    again = [(i, words, start, end) for i, words, start, end in lines if first[words] != i]
    assert all(set(range(start, end)) <= gone[i] for i, _, start, end in again)
    assert sum(len(words) < 5 for _, words, _, _ in again) > 20 and sum(5 <= len(words) < 20 for _, words, _, _ in again) > 20


def test_crowds_are_compared_exactly():
    random.seed(4)
    base = [{random.getrandbits(60) for _ in range(50)} for _ in range(12)]
    sets = []
    for _ in range(120):
        s = set(random.choice(base))
        for h in random.sample(sorted(s), random.randint(0, 6)):
            s.discard(h)
        sets.append(s)
    group = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j in range(i):
                if paragraphs.jaccard(a, sets[j]) >= 0.8:
                    group[i] = group[j] = min(group[i], group[j])
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in paragraphs.linked(sets):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(sets))] == group


# -- classifiers and the pipeline --
def _held_out(spark, query, label):
    sf = "/root/testdata/sf0.01"
    y = {r.doc_id: r[label] for r in queries.labels(spark, sf).collect()}
    rows = [(r.predicted, y[r.doc_id]) for r in query(spark, sf).collect() if r.held_out and r.doc_id in y]
    return rows


def test_quality_on_held_out_rows(spark):
    rows = _held_out(spark, queries.op2_quality, "quality")
    assert sum(p == y for p, y in rows) / len(rows) > 0.97


def _labelled(spark, n, seed):
    """Documents of random words whose labels follow their digits, with noise, and the rows to learn from."""
    rng = random.Random(seed)
    docs = [(i, " ".join("".join(rng.choice("abcXYZ12.,!#\n") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(3, 15)))) for i in range(n)]
    labels = [(i, int(sum(map(str.isdigit, t)) / len(t) + rng.gauss(0, 0.06) > 0.17)) for i, t in docs]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    return docs, [(i, y) for i, y in labels if common.fold_of(i, 5)], {r.doc_id: r for r in bradley_terry.score(*frames).collect()}


def test_quality_is_learned_from_all_pairs(spark):
    """Scores are those of a plain gradient on every pair of labelled rows."""
    docs, learn, found = _labelled(spark, 250, 5)
    x = np.array([bradley_terry.describe(t.encode()) for _, t in docs], np.float32).astype(np.float64)
    good, bad = (x[[i for i, y in learn if y == side]] for side in (1, 0))
    d = (good[:, None] - bad[None]).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-d @ w))
        w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(len(w)), d.T @ (1 - p) / len(d) - 1e-3 * w)
    raw = x @ w
    least = np.sort(raw[[i for i, _ in learn]])
    wanted = 1 / (1 + np.exp(-(raw - least[len(bad) - 1 : len(bad) + 1].mean() + np.log(0.3 / 0.7))))
    assert min(len(good), len(bad)) > 50 and max(abs(found[i].score - wanted[i]) for i, _ in docs) < 1e-6


def test_quality_cut_is_the_quantile_of_all_labelled_rows(spark):
    _, learn, found = _labelled(spark, 30_000, 6)
    assert len(learn) > 20_000 and sum(found[i].predicted for i, _ in learn) == sum(y for _, y in learn)


def test_midpoint_of_two_ranks(spark):
    values = [0.5, -3.0, 1e-300, 2.0, 2.0, 2.0, 7e8, 0.1, 0.1 + 1e-16]
    frame = spark.createDataFrame([(v,) for v in values], "raw double")
    for k in range(1, len(values)):
        low, high = sorted(values)[k - 1 : k + 1]
        assert bradley_terry.midpoint(frame, k) == (low + high) / 2


def _planted_votes(rng, n=4000):
    """Ten voters after the forms: 0 to 5 independent, 6 to 9 copies of one source; 5 is right half the time only."""
    y = rng.random(n) < 0.2
    accuracy = [0.9, 0.8, 0.9, 0.8, 0.9, 0.5]
    rate = [(0.6 * a / 0.2, 0.6 * (1 - a) / 0.8) for a in accuracy]
    votes = np.stack([rng.random(n) < np.where(y, min(0.95, r[0] * 0.25), r[1] * 0.25) for r in rate], axis=1)
    source = rng.random(n) < np.where(y, 0.3, 0.05)
    copies = np.stack([source & (rng.random(n) < 0.95) for _ in range(4)], axis=1)
    both = np.concatenate([votes, copies], axis=1)
    k = len(toxicity.FORMS)
    hits = [[k - 1] * (not row.any()) + (k + np.flatnonzero(row)).tolist() for row in both]
    return y, both, toxicity.Votes(hits, k + 10)


def test_label_model_finds_accuracies_and_correlated_voters():
    y, both, votes = _planted_votes(np.random.default_rng(11))
    k = len(toxicity.FORMS)
    prior, weight = np.array([0.2] * 4 + [0.1] + [0.75] * 10), np.array([0.0] * k + [20.0] * 10)
    model = toxicity.label_model(votes, 0.2, prior, weight)
    true = np.array([y[both[:, j]].mean() for j in range(10)])
    found = model.accuracy[k:]
    assert np.abs(found[:5] - true[:5]).max() < 0.15 and found[5] < found[:5].min()
    rho = np.concatenate([r for _, r in toxicity.correlations(votes, model.posterior, 4)])[k:, k:]
    apart = ~np.eye(10, dtype=bool)
    copies = np.zeros((10, 10), bool)
    copies[6:, 6:] = True
    assert rho[copies & apart].min() > 0.5 > 0.2 > np.abs(rho[~copies & apart]).max()
    # votes of the copies share their weight, lone votes keep theirs
    share = toxicity.shares(votes, model.posterior)
    assert share[(votes.terms >= k + 6) & np.isin(votes.rows, np.flatnonzero(both[:, 6:].all(axis=1)))].max() < 0.45
    alone = np.flatnonzero(both.sum(axis=1) == 1)
    assert share[(votes.terms >= k) & np.isin(votes.rows, alone)].min() > 0.99
    # correlations by blocks are those of the plain statement
    q = model.posterior
    dense = np.zeros((votes.n, votes.m))
    dense[votes.rows, votes.terms] = 1
    mean = (dense * q[:, None]).sum(0) / q.sum()
    cov = (dense * q[:, None]).T @ dense / q.sum() - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    plain = cov / np.outer(spread, spread)
    np.fill_diagonal(plain, 0)
    assert np.allclose(np.concatenate([r for _, r in toxicity.correlations(votes, q, 4)]), plain, atol=1e-3)
    right = (model.posterior > 0.5) == y
    assert right.mean() > 0.88 and abs(model.posterior.mean() - 0.2) < 1e-3


def test_voters_of_a_text():
    finder = toxicity.Finder(["=idiot", "achl-1", "achl-2", "achl-3", "long" * 40 + "-1", "=" + "w" * 90])
    names = [*toxicity.FORMS, *finder.number]
    say = lambda t: [names[i] for i in finder(t.encode())]
    assert say("You Idiot.") == ["ended", "=idiot"] and say("") == ["silent"]
    assert say("achlich achlich") == ["achl-1"] and say("achlich achlung") == ["achl-2"] and say("achla achlb achlc achld") == ["achl-3"]
    assert say("w" * 90) == ["=" + "w" * 90] and say("w" * 91) == ["silent"]  # whole words, never their beginnings


def test_copies_are_learned_from_once(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(i, text, 1) for i in range(50)] + [(100, text + " more", 1), (200, "other words here", 0), (201, None, 0), (202, "", 0)]
    kept = toxicity.families(spark.createDataFrame(rows, "d_id long, text string, y int")).collect()
    assert sorted(r.d_id for r in kept) == [0, 200, 201]


def test_toxicity_on_more_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    y = {r.doc_id: r.toxic for r in queries.labels(spark, sf).collect()}
    rows = [(r.predicted, y[r.doc_id]) for r in queries.op10_toxicity(spark, sf).collect() if r.held_out and r.doc_id in y]
    caught = sum(p and t for p, t in rows)
    assert caught >= 0.9 * sum(t for _, t in rows) and caught >= 0.95 * sum(p for p, _ in rows)


def test_toxicity_on_held_out_rows(spark):
    rows = _held_out(spark, queries.op10_toxicity, "toxic")
    assert sum(p == y for p, y in rows) / len(rows) > 0.93
    assert all(y for p, y in rows if p) and sum(p for p, y in rows if y) / sum(y for _, y in rows) > 0.6


def test_pipeline(spark):
    import corpus_pipeline

    sf, out = "/root/testdata/sf0.01", {}
    now = docs = common.documents(spark, sf)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf).cache()
        out[name] = [(r.doc_id, r.text or "", r.source) for r in now.collect()]
    prints = {i: plain_fingerprint(t) for i, t, _ in out["toxicity"]}
    kept = [i for i, _, _ in out["simhash"]]
    assert all(bin(prints[a] ^ prints[b]).count("1") > 2 for a in kept for b in kept if a < b)
    assert len(out["toxicity"]) < docs.count() and len(kept) < len(out["toxicity"])
    expected = removed(out["simhash"])
    for i, t, _ in out["suffix"]:
        assert abs(len(t.encode()) - (expected[i][0] - expected[i][1])) <= 3 * expected[i][2] * 2
    times = Counter(i for i, _, _ in out["mixing"])
    assert max(times.values()) <= 3 and set(times) <= {i for i, _, _ in out["suffix"]}
    assert corpus_pipeline.run(spark, sf).count() == len(out["mixing"])
