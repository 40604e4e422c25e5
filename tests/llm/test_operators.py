"""Every operator on small hard inputs: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import collections
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm import (attribution, chats, common, decontaminate, near_vectors, packing, personal_data, quality, queries,
                          repeated_passages, shingle_join, stages, url_filter)

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(40))
#: id, text: copies, near copies, nulls, a repeated row.
ROWS = [(1, PASSAGE + " tail one"), (2, PASSAGE + " tail one"), (3, "head " + PASSAGE + " tail one"), (4, None), (5, ""), (6, "  \n"), (7, "One two"), (8, "one TWO"),
        (9, LONG), (9, LONG), (None, PASSAGE), (10, "mail bob@x.org or +1 (555) 123-4567"), (11, "é\nü " * 50), (12, "one")]
SCHEMA = "doc_id long, text string, id string, start string, score string, bucket string, n string, label string, spans string, kept string"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(key, text) + ("clash",) * 8 for key, text in rows], SCHEMA).repartition(3)


def empty(spark):
    return frame(spark, [])


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def closure(ids, linked):
    component = {i: i for i in ids}
    for _ in ids:
        for a, b in linked:
            component[a] = component[b] = min(component[a], component[b])
    return component


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (7, 7), (9, 8), (8, 5), *((100, k) for k in range(101, 160)), *((k, k + 1) for k in range(200, 240))]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    wanted = closure({n for e in edges for n in e}, edges)
    assert got == {n: c for n, c in wanted.items() if n != 7}
    assert common.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_packing_round_trip(spark):
    definition = queries.tokenizer_text()
    encoder = Tokenizer.from_str(definition)
    rows = packing.pack(frame(spark), definition, capacity=64, pool_tokens=300).collect()
    wanted = collections.Counter((key, np.array(encoder.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for key, text in ROWS)
    # Equal rows give equal pieces: count each text's pieces by what they are.
    for (key, ids), times in wanted.items():
        pieces = [r for r in rows if r.doc_id == key and r.doc_tokens * 4 == len(ids)]
        assert sum(r.length for r in pieces) == times * len(ids) // 4
        assert all(bytes(r.ids) == ids[4 * r.start : 4 * (r.start + r.length)] for r in pieces)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length, r.padded_length))
    for parts in by.values():
        assert [o for o, _, _ in sorted(parts)] == list(itertools.accumulate([0, *(n for _, n, _ in sorted(parts))]))[:-1]
        total = sum(n for _, n, _ in parts)
        assert total <= 64 and parts[0][2] == (total if total.bit_count() == 1 else 64)
    assert packing.pack(empty(spark), definition).count() == 0


def test_token_counts(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as source:
        ranks = source.read()
    got = attribution.count_tokens(frame(spark), ranks, public_tokenizers.PATTERN).collect()
    encoder = attribution.Offsets(ranks, public_tokenizers.PATTERN).encoding
    total = collections.Counter()
    for key, text in ROWS:
        total[key] += len(encoder.encode_ordinary(text or ""))
    found = collections.Counter()
    for r in got:
        found[r.doc_id] += r.n_tokens
    assert found == total and {r.doc_id for r in got} == {key for key, _ in ROWS}
    sections = frame(spark, [(1, "abc def ghi"), (2, None)]).withColumn(
        "parts", F.when(F.col("doc_id") == 1, F.expr("array(named_struct('name','b','start',5L,'end',8L), named_struct('name','a','start',0L,'end',6L), named_struct('name','c','start',null,'end',9L))")))
    for rule in attribution.RULES:
        got = attribution.count_tokens(sections, ranks, public_tokenizers.PATTERN, sections_col="parts", rule=rule).where("doc_id = 1").collect()
        assert sum(r.n_tokens for r in got) == len(encoder.encode_ordinary("abc def ghi"))
        assert [(r.start, r.end) for r in sorted(got, key=lambda r: r.section) if r.section >= 0] == [(0, 6), (6, 8)]
    with pytest.raises(ValueError):
        attribution.count_tokens(sections, ranks, public_tokenizers.PATTERN, rule="none")
    assert attribution.count_tokens(empty(spark), ranks, public_tokenizers.PATTERN).count() == 0


def test_near_vectors(spark):
    draw = np.random.default_rng(0)
    base = draw.standard_normal((8, 16))
    rows = [(i, (base[i % 8] + 0.05 * draw.standard_normal(16)).tolist(), i % 2) for i in range(200)]
    rows += [(500 + i, rows[0][1], 0) for i in range(30)]
    rows += [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [None] * 16, 0), (904, rows[0][1], None),
             (905, [], 0), (906, rows[0][1][:8], 0), (None, rows[0][1], 0), (907, [float("inf")] + [1.0] * 15, 0)]
    df = spark.createDataFrame([(*row, "clash", "clash") for row in rows], "vec_id long, embedding array<double>, label int, node string, code string")
    got = {r.vec_id: r for r in near_vectors.near_duplicates(df, block=16).collect()}
    assert len(got) == len(rows)
    good = [(i, np.array(v), label) for i, v, label in rows if i is not None and i < 900]
    linked = [(a[0], b[0]) for a, b in itertools.combinations(good, 2) if a[2] == b[2] and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.98]
    degree = collections.Counter(n for pair in linked for n in pair)
    component = closure([i for i, _, _ in good], linked)
    for i, _, _ in good:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (degree[i], component[i], component[i] == i)
    for i in (900, 901, 902, 903, 904, 905, 906, 907):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, True)
    assert near_vectors.near_duplicates(df.limit(0)).count() == 0


def test_near_vectors_in_a_dense_label(spark):
    draw = np.random.default_rng(3)
    # One label of cosine 0.94 or so throughout, with lone pairs above the limit.
    base, spread = np.eye(64)[0], 0.25 * draw.standard_normal((2000, 64)) / 8
    twins = spread[:200] + 0.1 * draw.standard_normal((200, 64)) / 8
    rows = [(i, (base + v).tolist(), "hot") for i, v in enumerate(np.concatenate([spread, twins]))]
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(unit @ unit.T >= 0.98, 1))
    component = closure(range(len(rows)), list(zip(a.tolist(), b.tolist())))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: r.component_id for r in near_vectors.near_duplicates(df, passes=6, window=32).collect()}
    assert len(a) >= 200 and got == component


def weighted(a, b):
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def test_decontamination_against_all_windows(spark):
    items = [(1, PASSAGE), (2, "Short item"), (3, None), (4, "..."), (5, "q r s t u v w x y z a b"), (5, "q r s t u v w x y z a b")]
    texts = ROWS + [(20, "intro " + PASSAGE.upper().replace(" ", ", ") + " end"), (21, "the short, item here"), (22, PASSAGE.replace("p3 ", "zz ")), (23, "q r s t u v w x y z a b c"),
                    (24, " ".join(PASSAGE.split()[:20])), (25, "q r s t u v w x y z a"), (26, "q r s t u v w x y z")]
    bench = spark.createDataFrame([(*item, "clash") for item in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(frame(spark, texts), bench).collect()}

    def tokens(text):
        return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]

    def shingles(found, width):
        return [tuple(found[i : i + width]) for i in range(len(found) - width + 1)]

    wanted = {}
    for (key, text), (item, benchmark) in itertools.product(texts, items):
        own = tokens(benchmark)
        if not own:
            continue
        width = min(5, len(own))
        target, all_shingles = collections.Counter(shingles(own, width)), shingles(tokens(text), width)
        best = max((weighted(target, collections.Counter(all_shingles[s : s + len(own) - width + 1])) for s in range(len(all_shingles))), default=0)
        if best >= 0.8:
            wanted[key, item] = max(best, wanted.get((key, item), 0))
    assert set(got) == set(wanted)
    assert all(abs(got[pair].similarity - wanted[pair]) < 1e-9 for pair in got)
    assert (20, 1) in got and (21, 2) in got and (24, 1) not in got
    assert decontaminate.matches(empty(spark), bench).count() == 0
    assert decontaminate.matches(frame(spark), bench.limit(0)).count() == 0


def test_decontamination_with_repeated_items(spark):
    first, second = (" ".join(f"{letter}{i}" for i in range(30)) for letter in "ab")
    items = [(1, first), (1, first), (2, first), (2, second), (None, first), (None, second), (None, second)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [(30, "intro " + first + " end"), (31, second), (32, first + " mid " + second)])
    got = sorted(((r.doc_id, r.item_id, r.start, r.similarity) for r in decontaminate.matches(docs, bench).collect()), key=str)
    assert got == sorted([(30, 1, 1, 1.0), (30, 2, 1, 1.0), (30, None, 1, 1.0), (31, 2, 0, 1.0), (31, None, 0, 1.0),
                          (32, 1, 0, 1.0), (32, 2, 0, 1.0), (32, None, 0, 1.0)], key=str)


def test_decontamination_finds_all_edited_passages(spark):
    draw = np.random.default_rng(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    items, texts, similarities = [], [], []
    for key in range(300):
        # The last word is missing from short passages, a word is changed in longer ones.
        n = 9 if key % 2 else int(draw.integers(30, 60))
        own = [vocabulary[i] for i in draw.integers(0, 3000, n)]
        copy = own[:8] if n == 9 else own.copy()
        if n > 9:
            copy[int(draw.integers(n))] = "edited"
        sets = [collections.Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4)) for found in (own, copy)]
        similarities.append(weighted(*sets))
        items.append((key, " ".join(own)))
        texts.append((key, " ".join(copy)))
    wanted = {key: value for key, value in enumerate(similarities) if value >= 0.8}
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.similarity for r in decontaminate.matches(frame(spark, texts), bench).collect() if r.doc_id == r.item_id}
    assert sum(value < 0.85 for value in wanted.values()) > 60
    assert set(got) >= set(wanted) and all(got[key] >= value - 1e-9 for key, value in wanted.items())
    # By the blocks alone all but a few are found: those whose fingerprints happen to be far apart.
    alone = {r.doc_id for r in decontaminate.matches(frame(spark, texts), bench, complement=False).collect() if r.doc_id == r.item_id}
    assert alone <= set(got) and len(alone & set(wanted)) >= 0.9 * len(wanted)


def test_hamming_blocks_lose_nothing(spark):
    draw = np.random.default_rng(4)
    left = [int(v) for v in draw.integers(-(1 << 63), 1 << 63, 60)]
    right = [v ^ int(sum(1 << int(b) for b in draw.choice(62, int(draw.integers(0, 24)), False))) for v in left]
    a = spark.createDataFrame([(i, 1, v) for i, v in enumerate(left)], "a long, size int, fingerprint long")
    b = spark.createDataFrame([(i, 1, v) for i, v in enumerate(right)], "b long, size int, fingerprint long")
    got = sorted((r.a, r.b, r.hamming) for r in decontaminate.within_radius(a, b, "size", 15).collect())
    mask = (1 << 64) - 1
    wanted = sorted((i, j, ((x ^ y) & mask).bit_count()) for i, x in enumerate(left) for j, y in enumerate(right) if ((x ^ y) & mask).bit_count() <= 15)
    assert got == wanted and wanted


def test_quality(spark):
    texts = [(i, ("calm prose and words " if i % 3 else "LOUD!! NOISE!! ") * (1 + i % 5)) for i in range(300)] + [(None, "x"), (900, None), (901, ""), (902, LONG)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "clash") for i in range(300)] + [(7, 0, "clash"), (None, 1, "clash"), (8, None, "clash"), (9, 5, "clash")], "doc_id long, quality int, text string")
    docs = frame(spark, texts)
    model = quality.train(docs, labels, usable=~queries.held_out("key"), sample_bound=80)
    got = quality.score(docs, model)
    assert sorted(got.columns) == sorted(docs.columns)
    for r in got.collect():
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2:
            assert (r.score >= 0.7) == (r.doc_id % 3 > 0)
    assert quality.score(empty(spark), model).count() == 0
    assert 0 <= quality.train(docs, labels.limit(0)).score(b"x") <= 1


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op4_quality(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.95 * len(found)


URLS = [(1, "http://A.net/x?q#f"), (2, "https://b.example.NET/en/a"), (3, "http://example.com/de/"), (4, "http://x.org/fr/z"), (5, "http://notnet/x"), (6, None), (7, "nothing"),
        (8, "http://a.net"), (9, "ftp://h.net:80/x"), (10, "http://a.net?x=/y"), (11, "http://q.example.com/en/1"), (12, "x://y://a.net/"), (13, "http://a.net/\nb?c"), (1, "http://A.net/x?q#f")]


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return host.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER)), path


def test_url_rules(spark):
    pages = spark.createDataFrame([(*row, "clash", "clash", "clash") for row in URLS], "page_id long, url string, host string, rule string, label string")
    got = url_filter.judge(pages, queries.URL_RULES).collect()
    assert len(got) == len(URLS)
    by_id = dict(URLS)
    for r in got:
        host, path = parsed(by_id[r.page_id])
        fits = [(len(rule), rule, verdict) for verdict, rule in queries.URL_RULES
                if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith("/" + rule.split("/", 1)[1])]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("block", "allow")
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).count() == 0
    labelled = spark.createDataFrame([(f"http://spam{i}.com/buy", 1) for i in range(20)] + [(f"http://news{i}.com/read", 0) for i in range(20)], "url string, label int")
    judged = {r.host: r.verdict for r in url_filter.judge(spark.createDataFrame([(1, "http://spam99.com/buy"), (2, "http://news99.com/read")], "page_id long, url string"), [], labelled=labelled).collect()}
    assert judged == {"spam99.com": "block", "news99.com": "allow"}


def test_shingle_join(spark):
    base = [f"t{i}" for i in range(200)]
    extra = [(100 + k, " ".join(base[:k] + ["zz"] + base[k + 1 :])) for k in range(30)] + [(200, " ".join(base[:150])), (300, "b a"), (None, " ".join(base))]
    rows = ROWS + extra
    got = shingle_join.similar_documents(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    sets = {}
    for key, text in rows:
        found = [w.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER)) for w in words(text)]
        sets[key] = {tuple(found[i : i + 3]) for i in range(len(found) - 2)} if len(found) >= 3 else {tuple(found)} - {()}
    keys = [k for k in sets if k is not None and sets[k]]
    linked = [(a, b) for a, b in itertools.combinations(keys, 2) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    component = closure([k for k in sets if k is not None], linked)
    for r in got:
        # Two rows have no id: their texts differ, and they link with nothing.
        assert r.component_id == component.get(r.doc_id) and (r.doc_id is None or r.n_shingles == len(sets[r.doc_id]))
    assert any(component[k] != k for k in component)
    assert shingle_join.similar_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("size", [1 << 24, 1 << 12])
def test_repeated_passages(spark, size):
    texts = ROWS + [(30, LONG[100:5000]), (31, " ".join(["again"] * 40)), (32, " ".join(["again"] * 20)), (0, " ".join(PASSAGE.split()[5:18]))]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in repeated_passages.remove_repeats(frame(spark, texts), bucket_bytes=size).collect())
    first = {}
    for key, text in texts:
        found = words(text)
        for i in range(len(found) - 12):
            if key is not None:
                run = tuple(found[i : i + 13])
                first[run] = min(first.get(run, key), key)
    wanted = []
    for key, text in texts:
        found = words(text)
        gone = set()
        for i in range(len(found) - 12):
            if key is not None and first[tuple(found[i : i + 13])] < key:
                gone.update(range(i, i + 13))
        wanted.append((key is None, key or 0, len(found), len(gone), " ".join(w for i, w in enumerate(found) if i not in gone)))
    assert got == sorted(wanted)
    assert repeated_passages.remove_repeats(empty(spark)).count() == 0


def test_personal_data(spark):
    docs = frame(spark)
    model = personal_data.train(docs)
    got = personal_data.find(docs, model).collect()
    assert len(got) == len(ROWS)
    by_id = dict(ROWS)
    for r in got:
        base = [(span.start, personal_data.KINDS.index(span.kind), span.end) for span in r.spans if span.base]
        assert base == personal_data.base_spans(by_id[r.doc_id] or "")
    masked = {r.doc_id: r.text for r in personal_data.mask(docs, model).collect()}
    assert masked[10] == "mail [EMAIL] or [PHONE]" and masked[4] is None and masked[9] == LONG
    assert personal_data.find(empty(spark), personal_data.train(empty(spark))).count() == 0


def test_chats(spark):
    logs = {1: ["a"], 2: ["a", "b"], 3: ["a", "b", "c"], 4: ["a", "x"], 5: ["a", "b", "c"], 6: ["b"], 7: ["a", None], 8: ["a", ""], None: ["z"], 9: ["z", "y"], 10: ["q"] * 300}
    rows = [(key, i, "user" if i % 2 == 0 else "assistant", text, "clash", "clash") for key, texts in logs.items() for i, text in enumerate(texts)]
    rows.append((11, None, None, "first", "clash", "clash"))
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, id string, place string").repartition(4)
    got = {r.conv_id: r for r in chats.render(df).collect()}
    assert set(got) == {3, 4, 6, 7, 8, 9, 10, 11} and got[3].n_copies == 2 and got[10].n_turns == 300
    assert got[4].rendered == "<|user|>\na\n<|assistant|>\nx\n" and got[7].rendered == got[8].rendered
    assert chats.render(df.limit(0)).count() == 0


def test_stages_keep_columns_and_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns, name
    odd = docs.limit(20).unionByName(spark.createDataFrame([(None, None, None, None, None), (5000, "", "en", "s", 0)], docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, folder).count() > 0, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    assert stages.keep_good(spark, docs, folder).count() < plain
    near = spark.createDataFrame([(k, " ".join([*(f"t{i}" for i in range(100)), f"end{k}"]), "en", "s", 1) for k in range(5)], docs.schema)
    assert [r.doc_id for r in stages.keep_one_of_each(spark, near, folder).collect()] == [0]
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    leak = spark.createDataFrame([(1, "before " + bench + " after", "en", "s", 1), (2, "clean words", "en", "s", 1)], docs.schema)
    assert [r.doc_id for r in stages.drop_contaminated(spark, leak, folder).collect()] == [2]
    masked = stages.mask_personal_data(spark, spark.createDataFrame([(1, "a@b.com", "en", "s", 7)], docs.schema), folder).first()
    assert (masked.text, masked.n_chars) == ("[EMAIL]", 7)


def test_contamination_is_decided_by_row(spark):
    folder = "/root/testdata/sf0.001"
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    rows = [(key, text, "en", "s", 1) for key, text in [(None, "before " + bench), (None, "clean words"), (None, None), (None, "clean words"),
                                                        (7, bench + " after"), (7, "other clean words"), (8, None)]]
    got = stages.drop_contaminated(spark, spark.createDataFrame(rows, schema), folder).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == [(0, ""), (0, "clean words"), (0, "clean words"), (7, "other clean words"), (8, "")]


def test_near_copies_with_null_and_repeated_ids(spark):
    schema = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema
    near = [" ".join([*(f"t{i}" for i in range(100)), f"end{k}"]) for k in range(4)]
    other, lone = " ".join(f"o{i}" for i in range(50)), " ".join(f"n{i}" for i in range(50))
    rows = [(3, near[0]), (5, near[1]), (5, other), (None, near[2]), (None, near[2]), (None, lone), (None, lone), (6, lone + " more"), (7, "two words"), (7, "two words"),
            (None, None), (None, None), (8, ""), (8, "")]
    got = stages.keep_one_of_each(spark, spark.createDataFrame([(*row, "en", "s", 1) for row in rows], schema).repartition(3), "").collect()
    wanted = [(3, near[0]), (5, other), (6, lone + " more"), (7, "two words"), (None, None), (None, None), (8, ""), (8, "")]
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(wanted, key=str)


def test_stages_leave_clashing_columns_alone(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(40)
    clashing = docs.withColumns({name: F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")) for name in (
        "score", "_text", "_key", "_found", "_text_hash", "copies", "stays", "component", "node", "n")})
    extra = set(clashing.columns) - set(docs.columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, clashing, folder)
        assert kept.columns == clashing.columns, name
        rows = kept.collect()
        assert rows and all(row[column] == f"{column} {row.doc_id}" for row in rows for column in extra), name
        assert {row.doc_id for row in rows} == {row.doc_id for row in stage(spark, docs, folder).collect()}, name


def test_a_repeated_label_brings_one_row(spark):
    good, bad = ("a fine sentence about %d things", "BUY NOW $$$ %d")
    rows = [(k, (good if k % 2 else bad) % k) for k in range(40)] + [(1, f"{good % i} again") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    seen = []
    fit, quality.fit = quality.fit, lambda found, own, *rest, **options: seen.append(len(found)) or fit(found, own, *rest, **options)
    try:
        quality.train(docs, labels)
        quality.train(docs, labels, sample_bound=5)
        # Room for one or two rows of each label.
        quality.train(docs, labels, sample_bytes=1200)
    finally:
        quality.fit = fit
    assert seen[:2] == [40, 10] and 2 <= seen[2] < 10


def test_vectors_of_any_size_and_integer_ids(spark):
    rows = [(1, [1e200, 0.0], "a"), (2, [2e200, 1e190], "a"), (3, [1e-200, 0.0], "a"), (4, [0.0, 1e-300], "a"), (5, [0.0, 5e-324], "a"), (6, [3.0, 4.0], "a")]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_duplicates(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


def test_equal_sets_only(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (3, "a b c d f"), (4, "A  b c D e"), (5, "a b c d e a b c")]
    got = {r.doc_id: r.component_id for r in shingle_join.similar_documents(frame(spark, rows), percent=100).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5}


@pytest.mark.parametrize("percent, width", [(90, 3), (80, 5), (60, 2)])
def test_similar_documents_with_many_of_one_kind(spark, percent, width):
    """Groups around common passages, all against all in plain Python."""
    draw = np.random.default_rng(percent)
    passage = [f"s{i}" for i in range(40)]
    rows = []
    for key in range(160):
        own = [f"w{i}" for i in draw.integers(0, 60, int(draw.integers(1, 40)))]
        words_ = passage + own if key % 3 == 0 else own
        if key % 4 == 1 and rows:
            words_ = rows[int(draw.integers(len(rows)))][1].split()
            words_[int(draw.integers(len(words_)))] = "edit"
        rows.append((key, " ".join(words_)))
    sets = {key: set(zip(*(text.split()[k:] for k in range(width)))) or {tuple(text.split())} for key, text in rows}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    got = {r.doc_id: r.component_id for r in shingle_join.similar_documents(frame(spark, rows), width=width, percent=percent).collect()}
    assert linked and got == closure(list(sets), linked)


def test_components_beyond_one_task(spark, monkeypatch):
    """The distributed rounds give what one task gives."""
    draw = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 400, (300, 2))] + [(500, k) for k in range(501, 540)]
    df = spark.createDataFrame(edges, "src long, dst long").repartition(4)
    monkeypatch.setattr(common, "FEW", 0)
    got = {r.node: r.component for r in common.components(df).collect()}
    wanted = closure({n for a, b in edges if a != b for n in (a, b)}, edges)
    assert got == wanted
