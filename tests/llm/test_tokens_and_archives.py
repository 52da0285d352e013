"""Token counts, packing, archives, chat templates, vectors and the pipeline."""

import gzip
import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyforge.llm import chat_template as T
from tallyforge.llm import harmonic, queries, signature_tree, subspace_join, token_counts, warc, word_bpe
from tallyforge.llm.frames import table
from tallyforge.session import shared_root
from tests.llm import helpers as H

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), word_bpe.WordBpe(PATH)
ODD = [
    (1, None),
    (2, ""),
    (3, "Hello  WORLD, don't!! we'LL _x_ 3.14 ½ ² naïve\u00a0no-break \u2028 İstanbul ΣΑΣ ﬁ e\u0301 \x1c \x85 漢字漢字 \U0001f600\u200d"),
    (4, "a<|startoftext|>b <|endoftext|> </w> x</w>y <|endoftext|"),
    (5, "word " * 5000 + "y" * 3000),
    (5, "twice"),
    (6, "'s 'S ''s don''t \"'re\" '"),
]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list(" \n'stre<|>_AÉé.,!19½İΣ\u0301\u00a0"))), max_size=60))
def test_ids_equal_the_library(text):
    assert harmonic._ids(OWN, {}, text) == np.array(ids(text), "<u4").tobytes()
    found = OWN.pretokens(text)
    assert sum(len(x) // 4 for p in found for _, x in OWN.encode([p])) == len(ids(text))


def test_token_counts(spark, monkeypatch):
    monkeypatch.setattr(word_bpe, "PIECE_CHARS", 1000)
    docs = H.documents(spark, ODD).withColumnRenamed("lang", "n_tokens")
    found = token_counts.count_tokens(docs, PATH, ["doc_id"]).collect()
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found] == [(i, len((t or "").encode()), len(ids(t)), len(ids(t)) > 2048) for i, t in ODD]
    assert token_counts.count_tokens(docs.limit(0), PATH, ["doc_id"]).count() == 0


def test_token_query_equals_library(spark, base):
    texts = {r.doc_id: r.text for r in table(spark, base, "documents").collect()}
    assert all(r.n_tokens == len(ids(texts[r.doc_id])) for r in queries.op4_token_counts(spark, base).collect())


@pytest.mark.parametrize("length", [1, 5, 128, 129, 682, 683, 1023, 1024, 1025, 2047, 2048, 2049, 5000])
def test_cuts_fill_their_class(length):
    parts = harmonic.cuts(length, 2048)
    assert sum(parts) == length
    assert all(2048 - (2048 // p) * p <= 128 for p in parts)


def check_packing(rows, texts):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048
    for doc, text in texts:
        whole = [*ids(text), 1]
        own = sorted(pieces[doc, len(whole)], key=lambda r: r.start)
        assert own[0].start == 0 and sum(r.length for r in own) == len(whole)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(whole[r.start : r.start + r.length], "<u4").tobytes())
    return sum(r.length for r in rows) / (2048 * len(sequences))


def test_packing(spark):
    docs = H.documents(spark, ODD).withColumnRenamed("lang", "offset").coalesce(1)
    check_packing(harmonic.pack_documents(docs, PATH).collect(), ODD)
    with_ids = harmonic.pack_documents(docs, PATH, with_ids=True).where("doc_id = 3").orderBy("start").collect()
    assert [x for r in with_ids for x in r.ids] == [*ids(ODD[2][1]), 1]
    assert harmonic.pack_documents(docs.limit(0), PATH).count() == 0


def test_packing_with_a_small_table_of_words(spark):
    """Words that a worker has forgotten are encoded again: the table's size is no part of the result."""
    texts = [(i, " ".join(f"w{j} x{j}y." for j in range(i, i + 40))) for i in range(60)]
    docs = H.documents(spark, texts).coalesce(1)
    found = [harmonic.pack_documents(docs, PATH, keep_words=n).orderBy("doc_id", "start").collect() for n in (9, 1000)]
    assert found[0] == found[1]
    check_packing(found[0], texts)
    assert queries.PACKING_WORDS > word_bpe.KEEP_WORDS


def test_packing_query(spark, base):
    texts = [(r.doc_id, r.text) for r in table(spark, base, "documents").collect()]
    assert check_packing(queries.op6_harmonic_packing(spark, base).collect(), texts) > 0.97


# Archives

PAGES = [
    (1, "http://a/ü b\r\nX: y", "é" * 700),
    (2, None, "é" * 700),
    (3, "http://c", "small"),
    (4, "http://d", "small"),
    (5, "http://e", None),
    (6, "http://f", ""),
    (7, "http://g", "WARC/1.0\r\n\r\n" * 300_000),
    (7, "http://g", "WARC/1.0\r\n\r\n" * 300_000),
    (None, "http://h", "é" * 700),
]


def expected(pages):
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        top = max(j for j, _, h in pages if h == html and j is not None)
        again = len(data) >= 1000 and i is not None and i < top
        out.append((-1 if i is None else i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS chunk", "'x' AS data")
    archives = warc.write_archives(warc.record_table(pages), warc.new_folder(spark))
    assert sum(r.records for r in archives.collect()) == len(PAGES)
    last = warc.read_archives(archives, with_data=False).where("last").collect()
    assert sorted(((-1 if r.key is None else r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in last), key=str) == expected(PAGES)
    chunks = warc.read_archives(archives).where("key = 7").collect()
    assert max(len(r.data) for r in chunks) <= warc.CHUNK and len(chunks) == 2 * 4
    assert b"".join(r.data for r in sorted(chunks, key=lambda r: r.chunk)[::2]).decode() == PAGES[6][2]
    path = archives.first().path.removeprefix("file://")
    assert gzip.open(path).readline() == b"WARC/1.1\r\n"
    none = warc.write_archives(warc.record_table(pages.limit(0)), warc.new_folder(spark))
    assert warc.read_archives(none).count() == 0


def test_archive_query(spark, base):
    pages = [tuple(r) for r in table(spark, base, "pages").select("page_id", "url", "html").collect()]
    found = queries.op5_warc_chunks(spark, base).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == expected(pages)


# Templates


def render(source, *messages):
    return "".join(text for text, _ in T.compile_template(source)({"role": r, "text": t} for r, t in messages))


@pytest.mark.parametrize(
    "source, out",
    [
        ("a{# no #}b {{ 'x' ~ 1 | upper }}", "ab x1"),
        ("{% for m in messages %}{{ m.role }}:{{ m['text'] | trim | upper }};{% endfor %}", "user:HI;bot:YO;"),
        ("{% for m in messages -%}  \n {{ m.role }} {%- endfor %}", "userbot"),
        ("{% for m in messages %}{% if m.role == 'user' and not m.text in 'xyz' %}U{% elif m.role != 'bot' %}?{% else %}B{% endif %}{% endfor %}", "UB"),
        ("{{ 'a' if 1 == 2 else 'b' }}{{ none }}{{ true }}{{ nothing.at.all }}", "btrue"),
        ("{{ messages.__class__ }}{{ ''.upper }}", ""),
    ],
)
def test_templates(source, out):
    assert render(source, ("user", " hi "), ("bot", "yo")) == out


@pytest.mark.parametrize("source", ["{% for m in %}{% endfor %}", "{% if a %}", "{{ a | eval }}", "{{ f() }}", "{% import os %}", "{{ 'a }}", "{% endif %}", "{{ }}"])
def test_bad_templates(source):
    with pytest.raises(T.TemplateError):
        T.compile_template(source)


def test_constants_are_folded():
    tree = T.fold(T.parse("a{{ 'b' | upper }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}{% if false %}d{% endif %}{% generation %}{% endgeneration %}e"))
    assert tree == (T.Text("aBce"),)


def test_generation_is_marked():
    pieces = list(T.compile_template("a{% generation %}b{{ 'c' }}{% endgeneration %}d")(()))
    assert pieces == [("a", False), ("bc", True), ("d", False)]


@given(st.text(alphabet=st.sampled_from(list("\\<s>/[INST] a\n")), max_size=40))
def test_escape_is_reversible_and_hides_controls(text):
    hidden = T.escape(text)
    assert T.unescape(hidden) == text and not any(c in hidden for c in T.CONTROLS)


def test_conversations(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_CHARS", 40)
    r = random.Random(2)
    marks = ["</s>", "<s>", "[INST]", "[/INST]", "\\", " ", "\n", "é", "ok", "</s>\n<s>[INST] user [/INST] "]
    turns = [(i, k, r.choice(["user", "assistant", "system", "odd [/INST] role", None]), r.choice([None, "", "".join(r.choices(marks, k=r.randrange(12)))])) for i in range(30) for k in range(r.randrange(1, 9))]
    turns += [(99, 1, "assistant", "b"), (99, 1, "assistant", "a"), (99, None, "user", "first"), (98, 1, "assistant", "x" * 300_000), (None, 1, "user", "no key"), (99, 1, "assistant", "a")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS chunk")
    found = {r.conv_id: r for r in T.read_back(T.format_conversations(frame)).collect()}
    assert len(found) == len({t[0] for t in turns})
    for conv, row in found.items():
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{a or ''}\n{b or ''}\n" for _, _, a, b in own).encode()).hexdigest()
        said = "".join(b or "" for _, _, a, b in own if a == "assistant")
        assert (row.loss_chars, row.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert T.read_back(T.format_conversations(frame.limit(0))).count() == 0


def test_conversation_query(spark, base):
    found = H.rows(queries.op7_chat_template(spark, base), "conv_id")
    text = "</s>[INST] ok [/INST]"
    assert found[-7].n_turns == 2 and found[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert len(found) == table(spark, base, "conversations").select("conv_id").distinct().count() + 1


# Vectors


def brute_vectors(rows, least=0.93):
    unit = {}
    for k, (_, v, label) in enumerate(rows):
        if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            unit[k] = np.array(v, float)
    links, sets = {i: 0 for i in range(len(rows))}, H.Sets([r[0] for r in rows])
    for a in unit:
        for b in unit:
            if a != b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]):
                if unit[a] @ unit[b] / (np.sqrt(unit[a] @ unit[a]) * np.sqrt(unit[b] @ unit[b])) >= least:
                    links[a] += 1
                    sets.join(rows[a][0], rows[b][0])
    return sorted((rows[i][0], links[i], sets.find(rows[i][0])) for i in links)


@pytest.mark.parametrize("tight", [False, True])
def test_vectors_equal_brute_force(spark, monkeypatch, tight):
    if tight:  # more grid coordinates, cells in slices, shuffled joins
        for name, value in (("PER_GRID", 3), ("CELL_ROWS", 20), ("STEP", 7), ("BROADCAST_ROWS", 0)):
            monkeypatch.setattr(subspace_join, name, value)
    rng, rows = np.random.default_rng(8), []
    for _ in range(12):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 15)):
            v = (centre + rng.normal(size=16) * rng.choice([0.0, 0.15, 0.25, 0.35])).astype("f4").tolist()
            rows.append([len(rows), v, int(rng.integers(0, 2))])
    bad = float("nan")
    for v, label in ((None, 1), ([], 1), ([0.0] * 16, 1), ([1.0, None] + [1.0] * 14, 1), ([bad] * 16, 1), ([float("inf")] * 16, 1), (rows[0][1], None), ([1.0, 2.0], 1), ([2.0, 4.0], 1), (rows[3][1], rows[3][2])):
        rows.append([len(rows), v, label])
    frame = spark.createDataFrame([tuple(r) for r in rows], "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS node", "2 AS n")
    found = subspace_join.near_vectors(frame.repartition(3)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert subspace_join.near_vectors(frame.limit(0)).count() == 0


def test_no_task_holds_more_than_two_slices(spark, monkeypatch):
    monkeypatch.setattr(subspace_join, "CELL_ROWS", 50)
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(8) + 0.02 * rng.normal(size=8)).astype("f4").tolist(), 1) for i in range(700)]  # one dense cell
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = subspace_join.near_vectors(frame).collect()
    assert {r.component_id for r in found} == {0} and {r.n_links for r in found} == {699}
    sizes = [r["count"] for r in subspace_join.dealt_cells(frame.select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("copies"), "label", F.col("embedding").alias("vector"), F.lit(8).alias("d"), F.lit(1).alias("grid")), 0.93, "bigint").groupBy("label", "d", "block", "cell", "i", "j").count().collect()]
    assert len(sizes) > 100 and max(sizes) < 2 * 50 * 2


def placed_vectors(frame, grid=0):
    return frame.select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("copies"), "label", F.col("embedding").alias("vector"), F.size("embedding").alias("d"), F.lit(grid).alias("grid"))


def test_a_turn_sends_every_slice_to_one_task(spark, monkeypatch):
    monkeypatch.setattr(subspace_join, "CELL_ROWS", 100)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=64).astype("f4").tolist(), i % 3 % 2) for i in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    packed = subspace_join.slices(placed_vectors(frame), 0.93, "bigint")
    size = packed.agg(F.sum(F.length("rows"))).first()[0]
    assert size < 1500 * 64 * 4 * 1.5  # once, and not for each block and cell
    pairs, turns = Counter(), packed.agg(F.max("parts")).first()[0]
    for turn in range(turns):
        met = subspace_join.in_pairs(packed, turn, turn + 1)
        assert all(r.n == 1 for r in met.groupBy("label", "slice").agg(F.countDistinct("i", "j").alias("n")).collect())
        assert met.agg(F.sum(F.length("rows"))).first()[0] <= size
        pairs.update((r.label, r.i, r.j) for r in met.select("label", "i", "j").distinct().collect())
    assert turns == 10 and set(pairs) == {(k, i, j) for k, n in ((0, 10), (1, 5)) for i in range(n) for j in range(i, n)} and set(pairs.values()) == {1}


@pytest.mark.parametrize(("least", "d"), [(0.93, 64), (0.9995, 6)])
def test_vectors_in_many_slices_and_cells(spark, monkeypatch, least, d):
    for name, value in (("PER_GRID", 10), ("CELL_ROWS", 60), ("PIECE_VALUES", 500), ("STEP", 16), ("MOVED_ROWS", 0), ("TURNS", 3), ("BROADCAST_VECTORS", 0)):
        monkeypatch.setattr(subspace_join, name, value)
    rng, rows = np.random.default_rng(4), []
    for k in range(40):  # tight clusters, one of them large, and vectors between whose links hang on the last digits
        centre = rng.normal(size=d)
        for _ in range(150 if k == 0 else rng.integers(1, 8)):
            v = centre + rng.normal(size=d) * rng.choice([0.0, 0.02, 0.1]) * np.sqrt((1 - least) * 10)
            rows.append((len(rows), v.astype("f4").tolist(), "b" if k % 4 == 1 else "a"))
    for k in range(0, len(rows), 9):
        rows.append((len(rows), rows[k][1], rows[k][2]))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    found = subspace_join.near_vectors(frame.repartition(5), cosine=least).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == brute_vectors(rows, least)


def test_tiles_equal_single_pairs():
    rng = np.random.default_rng(6)
    x = np.concatenate([np.ones((90, 24)) + rng.normal(size=(90, 24)) * 0.3, rng.normal(size=(200, 24))]).astype("f4")
    x, copies = x[rng.permutation(290)], rng.integers(1, 4, 290)
    y = x.astype(float)
    size = np.sqrt(np.einsum("ij,ij->i", y, y))
    links = np.array([[a != b and y[a] @ y[b] / (size[a] * size[b]) >= 0.93 for b in range(290)] for a in range(290)])
    assert 400 < links.sum() < 8000
    cell = subspace_join.Compared(x, copies, 0.93, 32)
    for one, two in (((0, 200), (0, 200)), ((0, 200), (200, 290)), ((200, 290), (200, 290))):
        cell.compare(range(*one), range(*two))
    assert cell.n.tolist() == (links @ copies).tolist()
    root = np.arange(290)
    for _ in range(290):
        root = np.minimum(root, np.where(links, root, 290).min(axis=1))
    assert cell.roots().tolist() == root.tolist()


def test_vector_query(spark, base):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, base, "embeddings").collect()]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in queries.op8_subspace_join(spark, base).collect()) == brute_vectors(rows)


# Pipeline


def test_pipeline(spark, base):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near copies", "decontamination", "secrets", "packing"]
    docs = table(spark, base, "documents")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(corpus_pipeline.stored(stage(spark, kept[-1], base), "test"))
        assert kept[-1].columns == docs.columns
    ids_of = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    texts = {r.doc_id: r.text for r in kept[1].collect()}
    groups = H.near_duplicates(texts.items())
    assert ids_of[2] == {i for i, (_, c) in groups.items() if i == c}
    items = [tuple(r) for r in table(spark, base, "benchmark").select("item_id", "text").collect()]
    from tests.llm.test_text_scans import brute_contamination, brute_spans

    assert ids_of[3] == {i for i in ids_of[2] if not brute_contamination(texts[i], items)[1]}
    assert ids_of[4] == ids_of[3] and not any(brute_spans(r.text or "") for r in kept[4].collect())
    last = [(r.doc_id, r.text) for r in kept[4].collect()]
    assert check_packing(corpus_pipeline.run(spark, base).collect(), last) > 0.95


def test_near_copies_lose_no_text(spark, base):
    r = random.Random(2)
    a, b, c, d = (" ".join(f"{x}{r.randrange(10**6)}" for _ in range(50)) for x in "abcd")
    docs = H.documents(spark, [(1, a), (2, a), (2, b), (3, b + " tail"), (4, c), (4, d)])
    kept = corpus_pipeline.drop_near_copies(spark, docs.repartition(3), base)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, a), (2, b), (4, c), (4, d)]


def test_near_copies_of_odd_rows(spark, base):
    text = " ".join(f"w{i}" for i in range(50))
    docs = H.documents(spark, [(1, text), (1, text), (2, text + " x"), (3, "other words"), (None, text), (None, "alone"), (5, ""), (5, ""), (6, None)])
    docs = docs.withColumn("_row", F.lit(7)).withColumn("node", F.lit("x"))
    kept = corpus_pipeline.drop_near_copies(spark, docs, base)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text), r._row) for r in kept.collect()) == sorted([("1", text, 7), ("3", "other words", 7), ("None", "alone", 7), ("5", "", 7), ("5", "", 7), ("6", "None", 7)])
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), base).count() == 0


@pytest.mark.parametrize("clash", [False, True])
def test_near_copies_of_a_table_in_files(spark, tmp_path, base, clash):
    """Rows read from files are numbered by their place, without a copy of the table, unless a column has a name in the way."""
    r = random.Random(5)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(40)) for _ in range(30)]
    rows = [(i % 20, texts[i]) for i in range(30)] + [(100 + i, texts[i] + " more") for i in range(10)]
    docs = H.documents(spark, rows).withColumn("_file" if clash else "_row", F.lit("x")).repartition(6)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    before = set(os.listdir(f"{shared_root(spark)}/tallyforge-llm"))
    kept = corpus_pipeline.drop_near_copies(spark, docs, base)
    assert kept.columns == docs.columns and sorted((x.doc_id, x.text) for x in kept.collect()) == sorted(rows[:30])
    made = {n.rsplit("-", 1)[0] for n in set(os.listdir(f"{shared_root(spark)}/tallyforge-llm")) - before}
    assert ("numbered" in made) == clash and made <= {"numbered", "files", "near-copies"}


def test_pipeline_of_empty_tables(spark, tmp_path, base):
    for name in ("documents", "benchmark"):
        table(spark, base, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_steps_are_removed(spark):
    before = set(os.listdir(f"{shared_root(spark)}/tallyforge-llm"))
    text = " ".join(f"w{i}" for i in range(50))
    found = signature_tree.near_duplicates(H.documents(spark, [(1, text), (2, text + " x"), (3, "other words")]))
    left = set(os.listdir(f"{shared_root(spark)}/tallyforge-llm")) - before
    assert sorted(n.rsplit("-", 1)[0] for n in left) == ["members", "roots"] and found.count() == 3


def test_token_table_is_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SAMPLE_TEXTS", 3)
    docs = H.documents(spark, [(i, f"common w{i}") for i in range(300)] + [(None, "hot key")] * 100).repartition(4)
    words = token_counts.frequent_pretokens(docs, PATH, ["doc_id"])
    assert len(words) <= 2 * 3 * 3
    found = token_counts.count_tokens(docs, PATH, ["doc_id"]).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in found) == Counter((r.doc_id, len(ids(r.text))) for r in docs.collect())
    plan = token_counts.count_tokens(docs, PATH, ["doc_id"])._jdf.queryExecution().toString()
    assert "Exchange hash" not in plan
