"""Quality rules, suffix dedup, Jaccard join and decontamination against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from codesieve.llm import bytetext, decontaminate, jaccard_join, quality_rules, suffix_dedup
from tests.llm import brute


def ordered(rows):
    return sorted(rows, key=repr)


def test_quality_rules_on_odd_documents(odd, documents):
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    got = [tuple(r) for r in quality_rules.judge(odd).select(*names).collect()]
    assert ordered(got) == ordered(brute.quality([(i, t, s) for i, t, _, s in documents]))


def test_quality_rules_reject_depleted_documents(spark):
    footer = " ".join(f"footer{j}" for j in range(45))
    rows = [(k, f"{footer}\n" + " ".join(f"own{k}x{j}" for j in range(10 if k % 2 else 80)), "h") for k in range(30)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(table).collect()}
    assert kept == {r[0]: r[7] for r in brute.quality(rows)} == {k: k % 2 == 0 for k in range(30)}
    assert all(r.kept for r in quality_rules.judge(table, line_docs=99).collect())


def test_quality_rules_keep_rows_and_columns(odd, nothing, documents):
    good = quality_rules.keep_good(odd)
    want = brute.quality([(i, t, s) for i, t, _, s in documents])
    assert good.columns == odd.columns and good.count() == sum(r[7] for r in want)
    assert quality_rules.keep_good(nothing).count() == 0


def test_quality_rules_take_lines_out(spark, odd, nothing):
    line = "Stands  in\tmany documents "
    own = lambda k: " ".join(f"own{k}x{j}" for j in range(80))
    rows = [(k, f"{line}\n{own(k)}\n{line.upper()}\nonly in {k}\n\n \t", "h", 5) for k in range(30)]
    rows += [rows[3], (None, rows[4][1], "h", 5), (77, rows[5][1], "elsewhere", 5), (78, own(78), "h", 5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    got = quality_rules.keep_cleaned(table)
    clean = lambda k: f"{own(k)}\nonly in {k}\n\n \t"
    want = [(k, clean(k), "h", len(clean(k))) for k in [*range(30), 3]]
    want += [(None, clean(4), "h", len(clean(4))), rows[-2], rows[-1]]
    assert got.schema == table.schema and ordered(map(tuple, got.collect())) == ordered(want)
    whole = quality_rules.keep_cleaned(table, line_docs=99)
    assert ordered(whole.collect()) == ordered(table.collect())
    kept = quality_rules.keep_good(odd)
    assert quality_rules.keep_cleaned(odd).columns == odd.columns and quality_rules.keep_cleaned(odd).count() == kept.count()
    assert quality_rules.keep_cleaned(nothing).count() == 0


def test_one_of_a_large_group_of_near_copies_comes_through(spark):
    """Unedited lines of near copies are above the limits, so that all of them are depleted."""
    lines = [[f"g{g}l{j} " + " ".join(f"w{g}x{j}x{i}" for i in range(11)) for j in range(20)] for g in range(2)]
    rows = []
    for k in range(60):
        copy = lines[k % 2][:]
        copy[k // 2 % 20] += f" edit{k}"
        rows.append((k, "\n".join(copy), "h"))
    rows += [(100 + k, " ".join(f"own{k}x{j}" for j in range(80)), "h") for k in range(100)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.doc_id for r in quality_rules.judge(table).where("depleted").collect()} == set(range(60))
    got = corpus_pipeline.quality(spark, table, "").collect()
    texts = {r[0]: r[1] for r in rows}
    assert all(r.text == texts[r.doc_id] for r in got) and len(got) <= 100 + 40
    left = "\n".join(r.text for r in got).split("\n")
    assert all(line in left for group in lines for line in group)
    one = [r.doc_id for r in jaccard_join.keep_one(spark.createDataFrame(got), 5, 80).collect()]
    assert sorted(k % 2 for k in one if k < 100) == [0, 1] and len(one) == 102


def test_the_pipeline_takes_lines_out(spark):
    footer = "a line at the foot of every page"
    rows = [(k, f"{' '.join(f'own{k}x{j}' for j in range(80))}\n{footer}", "h") for k in range(30)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert not any(footer in r.text for r in corpus_pipeline.quality(spark, table, "").collect())


@pytest.mark.parametrize("letters", [1, 2, 3, 26])
def test_suffixes_are_sorted(letters):
    random = np.random.default_rng(letters)
    data = random.integers(97, 97 + letters, 3000).astype(np.uint8)
    data[2000:2400] = data[100:500]
    places = np.sort(random.choice(2950, 1500, replace=False))
    order, group = suffix_dedup.sort_suffixes(suffix_dedup.words_at(data), places, 50)
    strings = [data[places[i] : places[i] + 50].tobytes() for i in order]
    assert strings == sorted(strings)
    assert [a == b for a, b in zip(strings, strings[1:])] == (group[1:] == group[:-1]).tolist()


def test_suffixes_that_differ_in_one_byte_each():
    rows = [b"a" * 24 + bytes([x]) + b"b" * 12 + bytes([y]) + b"c" * 12 for x in (97, 98, 128, 255) for y in (0, 1, 127, 128)]
    data = np.frombuffer(b"".join(rows + rows), np.uint8)
    order, group = suffix_dedup.sort_suffixes(suffix_dedup.words_at(data), np.arange(0, len(data), 50), 50)
    strings = [(rows + rows)[i] for i in order]
    assert strings == sorted(strings) and group[-1] == len(rows) - 1


@pytest.mark.parametrize("blocks", [{}, {"block_bytes": 20_000, "bucket_bytes": 10_000}])
def test_suffix_dedup_on_odd_documents(odd, documents, blocks):
    result = suffix_dedup.dedup(odd, texts=True, **blocks)
    rows = result.collect()
    names = "doc_id n_bytes n_removed n_spans kept_sha256".split()
    assert ordered(tuple(r[n] for n in names) for r in rows) == ordered(brute.removed([(i, t) for i, t, _, _ in documents]))
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in rows)


def test_suffix_dedup_of_pieces_and_of_nothing(spark, nothing, monkeypatch):
    assert suffix_dedup.dedup(nothing).count() == 0
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    text = "".join(chr(97 + (k * k * 31 + k // 7) % 26) for k in range(5000))
    whole = suffix_dedup.Block(*_block([(1, text), (2, text[100:4000])]))
    strings = sorted((int(d), int(p)) for lo, hi, d in zip(whole.low, whole.high, whole.doc) for p in range(lo, hi + 1))
    assert strings == [(0, p) for p in range(4951)] + [(1, 5000 + p) for p in range(3851)]


def _block(rows):
    data = [t.encode() for _, t in rows]
    return (
        np.array([i for i, _ in rows], np.int64).tobytes(),
        np.ones(len(rows), np.bool_).tobytes(),
        np.array([len(d) for d in data], np.int64).tobytes(),
        b"".join(data),
    )


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (2, 60), (1, 70)])
def test_jaccard_join_on_documents(spark, small, size, percent):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = jaccard_join.groups(docs, size, percent).collect()
    assert ordered(map(tuple, got)) == ordered(brute.components(rows, size, percent))


def test_jaccard_join_on_odd_documents(odd, nothing, documents):
    rows = [(i, t) for i, t, _, _ in documents]
    got = jaccard_join.groups(odd, 3, 90).collect()
    assert ordered(map(tuple, got)) == ordered(brute.components(rows, 3, 90))
    assert jaccard_join.groups(nothing).count() == 0


@pytest.mark.parametrize("chunk", [256, 4])
def test_jaccard_join_of_a_large_group_of_near_copies(spark, monkeypatch, chunk):
    """Chains of edits: each text is linked with its neighbours only."""
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    base = [f"t{k}" for k in range(200)]
    rows = []
    for k in range(60):
        base = base[:]
        base[(k * 37) % 200] = f"e{k}"
        rows.append((k, " ".join(base)))
    got = jaccard_join.groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert ordered(map(tuple, got)) == ordered(brute.components(rows, 3, 90))


@pytest.mark.parametrize("size, percent", [(3, 90), (2, 60)])
def test_jaccard_join_of_a_chain_of_copies(spark, size, percent):
    """Each text is edited from the one before; all lists of shingles are counted, light and heavy ones."""
    draw = random.Random(size)
    words = [f"w{draw.randrange(400)}" for _ in range(150)]
    rows = []
    for k in range(220):
        words = list(words)
        words[draw.randrange(150)] = f"e{k}"
        rows.append((k, " ".join(words)))
    got = jaccard_join.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), size, percent).collect()
    assert ordered(map(tuple, got)) == ordered(brute.components(rows, size, percent))


def test_one_document_of_each_group_stays(odd, nothing, documents):
    rows = [(i, t) for i, t, _, _ in documents]
    one = jaccard_join.keep_one(odd, 3, 90)
    roots = {root for _, n, root in brute.groups(rows, 3, 90) if n}
    bare = sum(1 for _, n, _ in brute.groups(rows, 3, 90) if not n)
    assert one.columns == odd.columns and one.count() == len(roots) + bare
    assert jaccard_join.keep_one(nothing).count() == 0


ITEM = "A farmer named Peter Long has 12 sheep and buys 7 more from Mary before he walks 3 miles to the market with Peter Long again."
CHANGED = "A farmer named Hans Kurz has 15 sheep and buys 9 more from Olga before he walks 5 miles to the market with Hans Kurz again."
BROKEN = "A farmer named Hans Kurz has 15 sheep and buys 9 more from Olga before he walks 5 miles to the market with Otto Braun again."
MERGED = "A farmer named Hans Kurz has 15 sheep and buys 9 more from Hans before he walks 5 miles to the market with Hans Kurz again."


def test_decontamination_finds_changed_questions_with_consistent_slots(spark):
    lead, tail = "Here is some text that comes before. ", " And then the text goes on as it did."
    docs = [(k, lead + body + tail) for k, body in enumerate([ITEM, CHANGED, BROKEN, MERGED, "Nothing of the kind."])]
    items = [(7, ITEM), (8, "too short"), (9, None)]
    frames = [spark.createDataFrame(r, s) for r, s in ((docs, "doc_id long, text string"), (items, "item_id long, text string"))]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(*frames).collect()}
    assert set(got) == brute.contaminated(docs, [(i, t or "") for i, t in items])
    assert got[0, 7].kind == "copy" and got[1, 7].kind == "reparameterised"
    assert (2, 7) not in got or got[2, 7].n_matched < got[1, 7].n_matched
    assert (4, 7) not in got


def test_decontamination_drops_conflicting_windows_only(spark):
    """A name or number that contradicts the others costs the windows that hold it, not the whole passage."""
    pears = "He packs 2 ripe apples and then walks home over the old stone bridge to the farm where she keeps 2 green pears."
    thrice = "Then Peter went out and told the old man that Peter would soon be home again because Peter had lost his way there."
    half = "Then Peter went out and told the old man that he would soon be home again because Peter had lost 8 keys over there."
    often = "Then Peter and Peter saw that Peter had lost what Peter once gave to Peter on the old road to the town."
    bodies = [
        (7, ITEM, ITEM.replace("with Peter Long", "with Otto Braun"), 14, "copy"),
        (7, ITEM, ITEM.replace("A farmer named Peter", "A farmer named Otto"), 13, "copy"),
        (8, pears, pears.replace("2 green", "5 green"), 11, "copy"),
        (9, thrice, thrice.replace("Peter", "Hans", 2).replace("because Peter", "because Otto"), 8, "reparameterised"),
        (10, half, half.replace("Then Peter", "Then Otto").replace("8 keys", "9 keys"), 13, "reparameterised"),
        (11, often, often.replace("Peter", "Otto", 1).replace("Peter", "Karl", 1).replace("Peter", "Hans"), 9, "reparameterised"),
    ]
    items = {i: text for i, text, *_ in bodies}
    docs = [(k, f"Some lead. {body[2]} Some tail.") for k, body in enumerate(bodies)]
    frames = [spark.createDataFrame(r, s) for r, s in ((docs, "doc_id long, text string"), (items.items(), "item_id long, text string"))]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(*frames, coverage=0.4).collect()}
    assert {k: (r.n_matched, r.kind) for k, r in got.items()} == {(k, b[0]): b[3:] for k, b in enumerate(bodies)}
    assert decontaminate.keep_clean(*frames, coverage=0.4).count() == 0


def test_decontamination_on_documents(spark, small, odd, nothing):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    want = brute.contaminated([tuple(r) for r in docs.collect()], [tuple(r) for r in benchmark.collect()])
    found = decontaminate.matches(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want) > 0
    clean = decontaminate.keep_clean(docs, benchmark)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in want}
    assert decontaminate.keep_clean(odd, benchmark).count() == odd.count()
    assert decontaminate.keep_clean(odd, benchmark.limit(0)).columns == odd.columns
    assert decontaminate.matches(nothing, benchmark).count() == 0


def test_a_map_of_few_bits_only_costs_time(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    full, few = (decontaminate.matches(docs, benchmark, map_bits=b).collect() for b in (1 << 24, 1 << 13))
    assert ordered(full) == ordered(few)


def test_words_of_slices_end_with_their_documents():
    import pyarrow as pa

    texts = ["ab", "cd  e", None, "", "f"]
    found = []
    for part in bytetext.slices(pa.array(texts), 4):
        begin, stop = bytetext.word_bounds(part, ~bytetext.IS_SPACE[part.data])
        found += [part.data[a:b].tobytes() for a, b in zip(begin, stop)]
    assert found == [b"ab", b"cd", b"e", b"f"]


PROBES = [
    "Did Anna, Ben, Carl, Dora, Emil, Fritz, Gina and Hans meet Ida in Rome?",
    "WHICH OF THE RIVERS OF EUROPE IS THE LONGEST ONE?",
    "What is 12 plus 30?",
    "Wie viele Kilometer fährt der Zug von Berlin nach Hamburg, wenn er zwei Stunden unterwegs ist?",
]


def test_decontamination_finds_items_that_no_template_represents(spark):
    items = list(enumerate([*PROBES, "Why so?", "Who?"]))
    docs = [(k, f"Before it stands this. {text} And after it that.") for k, text in items]
    docs += [(100 + k, text.upper()) for k, text in items] + [(200, "Why so many of them? Who knows."), (201, "What is 12 plus 31?")]
    docs += [(300, PROBES[3].replace("Berlin", "Bremen").replace("Hamburg", "Kassel"))]
    frames = [spark.createDataFrame(r, s) for r, s in ((docs, "doc_id long, text string"), (items, "item_id long, text string"))]
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(*frames).collect()}
    whole = {(100 + k, k) for k, _ in items}
    within = {(k, k) for k in range(len(PROBES))}
    assert got >= whole | within
    assert got <= whole | within | {(300, 3)}
    assert got == brute.contaminated(docs, items) | (got & {(300, 3)})
    clean = {r.doc_id for r in decontaminate.keep_clean(*frames).collect()}
    assert {4, 5, 200, 201} <= clean


def test_units_of_four_languages():
    words = "12 Stunden 3 días 7 mètres 9 miles 4 € 5 Häuser".split()
    tokens = decontaminate.Tokens(next(bytetext.slices(pa.array([" ".join(words)]))))
    assert [tokens.kind[k] == decontaminate.UNIT for k in range(1, 12, 2)] == [True] * 5 + [False]
