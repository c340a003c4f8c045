"""Ranked search, packing and spelling variants against plain Python versions, on ordinary and on odd rows."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyframe.llm import packing, ranking, variants
from tallyframe.llm.common import slices
from tallyframe.llm.queries import ORACLES, QUERIES
from tests.llm.test_text_operators import ODD, SF, docs_of, given, nothing, odd  # noqa: F401 - fixtures

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_slices_cut_between_words_only():
    text = "ab cd " * 50 + "x" * 100
    parts = list(slices(text, re.compile(" "), 7))
    assert "".join(parts) == text and len(parts) > 20
    assert [w for p in parts for w in p.split()] == text.split()
    assert list(slices(None, re.compile(" "))) == [] == list(slices("", re.compile(" ")))


# ---------------------------------------------------------------- ranked search


def plain_ranking(docs, items, k=20):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))

    bags = [(key, Counter(terms(text))) for key, text in docs]
    bags = [(key, bag) for key, bag in bags if bag]
    frequency = Counter(t for _, bag in bags for t in bag)
    n, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    rows = []
    for item, text in items:
        scored = []
        for key, bag in bags:
            m = 75 + (25 * sum(bag.values()) * n) // total
            score = 0
            for term in terms(text):
                if tf := bag.get(term):
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * frequency[term] + 1)))
                    score += w * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0 and key is not None:
                scored.append((-score, key))
        rows += [(item, rank, key, -score) for rank, (score, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=repr)


def ranked(spark, docs, items, **options):
    asked = spark.createDataFrame([(*item, "clash") for item in items], "item_id long, text string, doc_id string")
    found = ranking.ranked_search(docs, asked, **options)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_ranking_of_odd_rows(spark, odd):
    items = [(1, "THE same text, who am I?"), (2, "long"), (3, ""), (4, None), (None, "text ① 梦 é"), (1, "end word word")]
    wanted = plain_ranking([(r[0], r[1]) for r in ODD], items)
    assert ranked(spark, odd, items) == wanted
    assert ranked(spark, odd, items, block_chars=9) == wanted, "any number of blocks gives the same"
    assert ranked(spark, odd, [*items, items[0]]) == wanted, "items that repeat count once"


def test_ranking_of_nothing(spark, odd, nothing):
    assert ranked(spark, nothing, [(1, "text")]) == []
    assert ranked(spark, odd, []) == []


def test_ranking_of_ties_goes_by_id(spark):
    docs = docs_of(spark, [(i, "two words" if i % 2 else "other things here", "en", "a") for i in range(200, 0, -1)])
    assert ranked(spark, docs, [(5, "words")], k=3) == [(5, 1, 1, s := ranked(spark, docs, [(5, "words")], k=1)[0][3]), (5, 2, 3, s), (5, 3, 5, s)]


def test_ranking_prunes_and_stays_exact(spark, given, monkeypatch):
    docs, _ = given
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    monkeypatch.setattr(ranking, "MOST_VECTORS", 16)
    monkeypatch.setattr(ranking, "LEAST_VECTORS", 4)
    assert ranked(spark, docs, items) == plain_ranking(rows, items)


def test_bounds_pass_over_buckets():
    random = np.random.default_rng(3)
    weights = random.integers(1, 5000, 40)
    queries = ranking.Queries([{t: 1 for t in random.choice(40, 6, replace=False).tolist()} for _ in range(20)], weights)
    passed = found = 0
    for scale in (1000, 300, 30):
        terms = np.concatenate([np.sort(random.choice(40, 12, replace=False)) for _ in range(64)])
        impacts = random.integers(1, scale, len(terms))
        starts = np.arange(0, len(terms) + 1, 12)
        lengths = np.sqrt(np.add.reduceat(weights[terms] * impacts.astype(float) ** 2, starts[:-1]))
        bucket = ranking.Bucket(np.arange(64), lengths, terms, impacts, starts)
        for q in range(20):
            dense = np.zeros(40, dtype=np.int64)
            dense[queries.terms[q]] = queries.values[q]
            exact = np.add.reduceat(dense[terms] * impacts, starts[:-1])
            needed = 4_000_000
            places = bucket.survivors(queries, q, needed)
            assert set(np.flatnonzero(exact >= needed)) <= set(places.tolist())
            assert (bucket.scores(places, dense) == exact[places]).all() if len(places) else True
            passed, found = passed + (64 - len(places)), found + len(places)
    assert found and passed > found, "most vectors are left out by bounds"


# ---------------------------------------------------------------- packing


def check_packing(rows, texts, window=2048):
    """Every id in one piece; sequences without gaps, full or a power of two."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    wanted = Counter((key, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (1,)) for key, text in texts)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], len(r["ids"]) // 4))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at and size > 0
            at += size
        assert at == window or (at < window and at & (at - 1) == 0)
    by_document = defaultdict(list)
    for r in rows:
        by_document[r["doc_id"], r["doc_tokens"]].append((r["start"], tuple(np.frombuffer(r["ids"], dtype="<u4").tolist())))
    for (key, size), pieces in by_document.items():
        same = [ids for (k, ids), n in wanted.items() for _ in range(n) if k == key and len(ids) == size]
        assert sum(len(ids) for _, ids in pieces) == size * len(same)
        covered = Counter(p for start, ids in pieces for p in enumerate(ids, start))
        assert covered == Counter(p for ids in same for p in enumerate(ids))
    assert sum(len(p) for p in by_document.values()) == len(rows)
    assert {key for key, _ in wanted} == {key for key, _ in by_document}


def test_packing_of_odd_rows(spark, odd):
    rows = packing.pack(odd, TOKENIZER).collect()
    check_packing(rows, [(r[0], r[1]) for r in ODD])
    assert min(r["doc_tokens"] for r in rows) == 1


def test_packing_of_nothing(spark, nothing):
    assert packing.pack(nothing, TOKENIZER).count() == 0


def test_packing_of_given_documents(spark, given):
    docs, _ = given
    pieces = packing.pack(docs, TOKENIZER)
    rows = pieces.collect()
    check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    report = {(r["doc_id"], r["start"]): r for r in packing.piece_report(pieces).collect()}
    for r in rows:
        line = report[r["doc_id"], r["start"]]
        assert line["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and line["length"] == len(r["ids"]) // 4
    for line in packing.sequences(pieces).collect():
        assert line["length"] == sum(len(p["ids"]) // 4 for p in line["pieces"])
        assert [p["offset"] for p in line["pieces"]] == sorted(p["offset"] for p in line["pieces"])


def test_word_by_word_ids_equal_the_tokenizer():
    encoder = packing.WordEncoder(TOKENIZER, 1)
    texts = [
        "It's THE <|ENDOFTEXT|> and <|endoftext|> x<|startoftext|>y Éa café é  wide 123 a's 'S ''' ΣΑΣ. \x1c\x0b梦",
        "wait... no., a.b. c,. d ,. e. " + "z" * 100 + " 1.5e10. ü. ÷ ß, Ÿ µ ª.", "日本語" * 50, "word " * 9000, "é" * 300 + " end", None, "",
        "mail me@home.org, or 10.0.0.1. done.\nnext, line.\r\n\tlast .",
    ]
    wanted = [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert [a.tolist() for a in encoder.encode_all(texts)] == wanted
    assert [encoder.encode_all([t])[0].tolist() for t in texts] == wanted


def test_a_word_is_looked_up_once_for_all_its_places():
    class Counted(dict):
        asked = 0

        def get(self, *of):
            Counted.asked += 1
            return super().get(*of)

    encoder = packing.WordEncoder(TOKENIZER, None)
    encoder.numbers = Counted(encoder.numbers)
    texts = ["some words  again\n" * 5000 + "q" * 50, "again " + "q" * 50]
    wanted = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [a.tolist() for a in encoder.encode_all(texts)] == wanted
    assert Counted.asked <= 10


def test_words_forgotten_are_found_again(monkeypatch):
    monkeypatch.setattr(packing, "MOST_WORDS", 50)
    monkeypatch.setattr(packing, "_PART_CHARS", 100)
    encoder = packing.WordEncoder(TOKENIZER, None)
    text = " ".join(f"word{i}x. And" for i in range(300))
    assert encoder.encode_all([text, "a b", text])[2].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_sum_of_squares_rule_against_every_choice():
    random = np.random.default_rng(8)
    levels, window, levels_now = packing.Levels(32), 32, Counter()
    for size in random.integers(1, 33, 3000).tolist():
        def total(counts):
            return sum(n * n for h, n in counts.items() if 0 < h < window)

        choices = {}
        for h in [0, *[h for h, n in levels_now.items() if n and 0 < h]]:
            if h + size <= window:
                after = levels_now.copy()
                if h:
                    after[h] -= 1
                after[h + size] += 1
                choices[h] = total(after)
        least = min(choices.values())
        level = levels.level_for(size)
        assert level == max(h for h, s in choices.items() if s == least)
        filled = levels.put(packing.Piece((0, size), 0, np.zeros(size, dtype="<u4")))
        if level:
            levels_now[level] -= 1
        if level + size < window:
            levels_now[level + size] += 1
        assert (filled is not None) == (level + size == window)
        assert [levels_now[h] for h in range(1, window)] == levels.counts[1:window].tolist()


def test_few_open_windows_lose_nothing():
    random = np.random.default_rng(2)
    ids = [np.arange(n, dtype="<u4") for n in random.integers(1, 3 * 64, 500).tolist()] + [np.zeros(40, dtype="<u4")] * 300
    found = list(packing.sequences_of(((i, line) for i, line in enumerate(ids)), 64, 8))
    sizes = [sum(len(p.ids) for p in s) for s in found]
    assert sum(sizes) == sum(map(len, ids)) and sum(n < 64 for n in sizes) <= 6
    covered = defaultdict(list)
    for sequence in found:
        for piece in sequence:
            covered[piece.row] += range(piece.start, piece.start + len(piece.ids))
    assert all(sorted(covered[i]) == list(range(len(line))) for i, line in enumerate(ids))


# ---------------------------------------------------------------- spelling variants


def plain_words(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def variant_rows(docs):
    found = variants.spelling_variants(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in found.collect())


def test_variants_of_given_documents(spark, given):
    docs, _ = given
    words = plain_words([(r["doc_id"], r["text"]) for r in docs.collect()])
    found = variant_rows(docs)
    assert found == plain_variants(words)
    assert any(r[1] != r[2] for r in found if r[1]), "chains of forms are followed"


def test_variants_of_odd_rows(spark, odd):
    assert variant_rows(odd) == plain_variants(plain_words([(r[0], r[1]) for r in ODD]))


def test_variants_of_nothing(spark, nothing):
    assert variant_rows(nothing) == []


def test_near_words_of_few_letters(spark):
    """Many anagrams, repeated letters, letters beyond ASCII and chains of insertions: every pair once, no other."""
    random = np.random.default_rng(6)
    words = {"".join(random.choice(list("abé"), size)) for size in random.integers(4, 9, 1200)} | {"a" * n for n in range(5, 40)} | {"x" * 50_000, "x" * 50_001}
    table = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    found = [(r["word_a"], r["word_b"]) for r in variants.near_words(table).collect()]
    ordered = sorted(words, key=lambda w: (len(w), w))
    wanted = {(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if len(b) - len(a) < 2 and len(b) < 50_000 and one_edit(a, b)}
    assert len(found) == len(set(found)) and set(found) == wanted | {("x" * 50_000, "x" * 50_001)}


def test_long_chains_of_forms_end_at_the_last(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)]
    found = {r["word"]: r["root"] for r in variants._roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert found == {f"w{i}": "w37" for i in range(37)}


def test_forms_need_a_ratio(spark, odd):
    with pytest.raises(ValueError):
        variants.spelling_variants(odd, ratio=1)


# ---------------------------------------------------------------- registered


def test_ranked_search_against_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    wanted = connection.sql(ORACLES["op11_ranked_search"]).fetchall()
    found = [tuple(r) for r in QUERIES["op11_ranked_search"](spark, SF).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(found) == sorted(wanted) and found


def test_registered_results(spark):
    packed = QUERIES["op12_window_packing"](spark, SF)
    assert packed.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {t for c, t in packed.dtypes if c != "doc_id"} == {"bigint"}
    assert packed.select("doc_id").distinct().count() == 200
    variants_ = QUERIES["op13_spelling_variants"](spark, SF)
    assert dict(variants_.dtypes)["n"] == "bigint" and dict(variants_.dtypes)["n_near"] == "bigint"
    assert variants_.filter(F.col("form").isNull() != F.col("form_n").isNull()).isEmpty()


# ---------------------------------------------------------------- pipeline on repeated ids and clashing names


def test_texts_under_one_id_are_judged_by_themselves(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w59", "other")
    alone, third = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, base), (5, near), (5, alone), (5, alone), (5, third), (5, None), (6, third + " more"), (7, "x y"), (7, "x y"), (None, base), (None, base)]
    path = str(tmp_path / "docs")
    docs_of(spark, [(key, text, "en", "a") for key, text in rows]).withColumnsRenamed({"kept": "_text_key", "n_words": "own_id"}).write.parquet(path)
    docs = spark.read.parquet(path)
    found = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert found.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)
    # The texts of 5: the near copy goes; the others stay, the third or its near copy under 6.
    assert got.count((None, base)) == 2 and (1, base) in got and (5, near) not in got
    assert got.count((5, alone)) == 1 and (5, None) in got and got.count((7, "x y")) == 1
    assert ((5, third) in got) != ((6, third + " more") in got)
    assert len(got) == 7
    assert sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()), key=str) == got


def test_mix_keeps_columns_whose_names_clash(spark, odd):
    clash = odd.withColumnsRenamed({"kept": "_id", "n_words": "_copies", "score": "_COPY"})
    mixed, plain = corpus_pipeline.mix_sources(spark, clash, SF), corpus_pipeline.mix_sources(spark, odd, SF)
    assert mixed.columns == clash.columns
    assert sorted(map(str, map(tuple, mixed.collect()))) == sorted(map(str, map(tuple, plain.collect())))
