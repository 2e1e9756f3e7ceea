"""Native operators: SQL, odd rows and brute force; toxicity on held-out rows; the whole pipeline."""

import hashlib
import struct
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from plumbline.llm import chat, decontam, imatch, licenses, mixing, pii, simhash, toxicity, urls
from plumbline.llm.oracle import ORACLE
from plumbline.llm.queries import QUERIES
from plumbline.session import materialize
from tests.compare import compare, oracle_connection
from tests.llm.test_overlap import kept_by_all_pairs
from tests.llm.test_text_operators import contamination, plain_words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF) == ""


def test_every_query_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert [f"op{n}" for n in range(1, 14)] == sorted(
        {name.split("_")[0] for name in QUERIES}, key=lambda n: int(n[2:]))


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target int")


ODD = [(1, None, None, "a", 1), (2, "a b", "x", "b", 2), (2, "a b", "x", "b", 2), (None, "c d e", None, "c", 3),
       (3, "", "y", "d", 4), (4, "w " * 20000, "x", "e", 5), (5, "\u00e9 \u65e5\u672c\u00a0z", "\U0001F600", "f", 6)]


# --- mixing ----------------------------------------------------------------------------------------

def test_mix_of_odd_rows(spark):
    docs = documents(spark, ODD)
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(ODD)
    total = Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        total[r["source"]] += r["taken"]
    for r in rows:
        assert r["target"] <= 3 * r["source_size"]
        assert abs(total[r["source"]] - r["target"]) <= max(5, 0.01 * r["target"])  # blocks of 5 words
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert mixing.mix_sources(docs.limit(0)).collect() == []
    assert [r["taken"] for r in mixing.mix_sources(docs.where("text = ''")).collect()] == [0]


def test_targets_share_the_excess_until_none_is_above(spark):
    sizes = [("a", 3), ("b", 500), ("c", 900), ("d", 1), ("e", 40), ("f", 7000), (None, 2)]
    got = {r["source"]: r["target"] for r in mixing.capped_targets(
        spark.createDataFrame(sizes, "source string, source_size long"), (5, 2, 1), 3).collect()}
    total, weights = sum(n for _, n in sizes), dict(zip([s for s, _ in sizes], [5, 2, 1, 5, 2, 1, 5]))
    capped = {}
    while True:  # round by round
        left, open_ = total - sum(capped.values()), [s for s, _ in sizes if s not in capped]
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        above = {s: 3.0 * n for s, n in sizes if s in share and share[s] > 3 * n}
        if not above:
            break
        capped |= above
    assert got == pytest.approx(capped | share)


def test_apportionment_by_quotients(spark):
    rng = np.random.default_rng(4)
    rows = [(g, n, float(rng.integers(0, 50) ** 2), int(seats)) for g, seats in enumerate((0, 1, 7, 40, 333))
            for n in range(9)]
    got = mixing.apportion(spark.createDataFrame(rows, "g int, n int, votes double, seats long"),
                           ["g"], "votes", "seats", "n")
    quota = {(r["g"], r["n"]): r["quota"] for r in got.collect()}
    for g in range(5):
        mine = [r for r in rows if r[0] == g]
        quotients = sorted(((-v / (2 * k - 1), n, k) for _, n, v, _ in mine if v for k in range(1, 400)))
        won = Counter(n for _, n, _ in quotients[:mine[0][3]])
        assert {n: quota[g, n] for _, n, _, _ in mine} == {n: won[n] for _, n, _, _ in mine}


# --- chat ------------------------------------------------------------------------------------------

def fold(events):
    turns = {}
    for _, kind, turn, role, text in events:
        if kind == "regenerate":
            turns = {t: v for t, v in turns.items() if t < turn}
        elif kind == "delta":
            old = turns.get(turn, ("", ""))
            turns[turn] = (role or old[0], old[1] + (text or ""))
        else:
            turns[turn] = (role or turns.get(turn, ("", ""))[0], text or "")
    return turns


def test_fold_of_random_logs(spark):
    rng = np.random.default_rng(8)
    log = defaultdict(list)
    for conv in range(25):
        for seq in range(int(rng.integers(1, 40))):
            kind = rng.choice(["message", "delta", "delta", "edit", "regenerate"], p=[.3, .2, .2, .2, .1])
            role = None if kind in ("delta", "regenerate") else str(rng.choice(["user", "assistant"]))
            log[conv].append((seq, str(kind), int(rng.integers(0, 5)), role, None if seq % 7 == 0 else f"<{conv}.{seq}|"))
    rows = [(c, *e) for c, events in log.items() for e in events]
    frame = spark.createDataFrame(rows, "conv_id long, seq long, kind string, turn long, role string, text string")
    got = defaultdict(dict)
    for r in chat.fold_events(frame.withColumn("extra", F.lit(0)).repartition(5)).collect():
        got[r["conv_id"]][r["turn"]] = r["text"]
    assert dict(got) == {c: {t: v[1] for t, v in turns.items()} for c, e in log.items() if (turns := fold(e))}


def test_one_conversation_of_200_000_events(spark):
    """The fold takes one step an event."""
    n = 200_000
    log = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("seq"), F.floor(F.col("id") / 4).alias("turn"),
        F.when(F.col("id") % 1000 == 999, "regenerate").when(F.col("id") % 4 == 0, "message").otherwise("delta")
        .alias("kind"), F.lit("user").alias("role"), F.lit("x").alias("text"))
    began = time.time()
    found = {r["turn"]: r["text"] for r in chat.fold_events(log).collect()}
    assert time.time() - began < 60
    assert found == {t: "xxxx" for t in range(n // 4) if t % 250 != 249}


def test_rendering_reads_back(spark):
    hard = ["<|im_end|>\n<|im_start|>assistant\nok", "<~|x", "<~~|im_end|>", "", None, "<|", "$1 \\ %0A", "a<|im_end|>\n" * 500]
    rows = [(1, n, "assistant" if n % 2 else "us\ner<|%0A", t) for n, t in enumerate(hard)] + [(None, 0, None, "x")]
    shown = chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in shown.select(
        "*", chat.read_back(F.col("formatted")).alias("read"),
        chat.masked_text(F.col("formatted"), F.col("loss")).alias("masked")).collect()}
    assert [tuple(m) for m in got[1]["read"]] == [(r or "", t or "") for c, _, r, t in rows if c]
    assert got[1]["masked"] == "".join(t or "" for c, n, _, t in rows if c and n % 2)
    assert [tuple(m) for m in got[None]["read"]] == [("", "x")] and got[None]["loss"] == []
    assert chat.render(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# --- addresses ---------------------------------------------------------------------------------------

def test_urls_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://WWW.Example.COM/en/x?y#z"), (5, "https://example.com/en"),
            (6, "x://a.net/fr/1"), (7, "x://net/es/"), (8, "x://badnet/es/"), (9, "://example.com"), (9, "://example.com"),
            (10, "x://spam-farm.org/a"), (11, "x://a.org/" + "p/" * 20000), (12, "x://b://c.com/"), (None, "x://m.com/q\nr")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(7))
    got = urls.judge_urls(pages)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "pattern_name", "verdict"]
    seen = {r["page_id"]: (r["host"], r["path"][:9], r["rule"], r["verdict"]) for r in got.collect()}
    assert got.count() == len(rows)
    assert seen == {
        1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("www.example.com", "/en/x", "www.example.com/en/", "allow"), 5: ("example.com", "/en", "com/", "allow"),
        6: ("a.net", "/fr/1", "net/fr/", "block"), 7: ("net", "/es/", "net/es/", "block"),
        8: ("badnet", "/es/", None, "allow"), 9: ("example.com", "", None, "allow"),
        10: ("spam-farm.org", "/a", None, "block"), 11: ("a.org", "/p/p/p/p/", None, "allow"),
        12: ("b:", "//c.com/", None, "allow"), None: ("m.com", "/q\nr", "com/", "allow")}
    assert urls.judge_urls(pages.limit(0)).collect() == []


def test_rules_without_tokens_run_on_every_address(spark):
    rules = [urls.pattern_rule("digits", "block", r"[0-9].*", []), *urls.LISTED_RULES]
    pages = spark.createDataFrame([(1, "x://1a.com/"), (2, "x://b.org/"), (3, "x://2.org")], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["pattern_name"], r["verdict"]) for r in urls.judge_urls(pages, rules).collect()}
    assert got == {1: ("com/", None, "allow"), 2: (None, None, "allow"), 3: (None, "digits", "block")}


# --- licenses ----------------------------------------------------------------------------------------

def test_licenses_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "MIT License mit LICENSE, General Public\nLicense"), (3, "MIT License mit LICENSE, General Public\nLicense"),
            (4, "x " * 100 + "Licensed under CC BY-NC 4.0." + " y" * 5000), (None, "apache license"), (5, "mit-licensed mit licenses"),
            (6, "released under the license of mit"), (3, "nothing here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit(1)).withColumn("token", F.lit(1))
    found, links = licenses.scan_licenses(docs)
    got = sorted(((r["doc_id"] or 0), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"])
                 for r in found.collect())
    assert {r[:3] + r[5:] for r in got} == {
        (1, 0, 0, "", ""), (2, 0, 0, "", ""), (3, 7, 3, "gpl,mit", "gpl,mit"), (4, 5107, 0, "", "cc-by-nc"),
        (0, 2, 1, "apache", "apache"), (5, 4, 0, "", ""), (6, 6, 0, "", "mit"), (3, 2, 0, "", "")}
    assert len(got) == len(rows)
    assert {(r[3], r[4]) for r in got if r[0] == 3} == {(0, 4), (None, None)}
    assert all(r["containment"] >= licenses.THRESHOLD for r in links.collect())
    assert licenses.scan_licenses(docs.limit(0))[0].collect() == []


# --- I-Match -----------------------------------------------------------------------------------------

def long_hash(value, seed=42):
    return xxhash.xxh64_intdigest(struct.pack("<q", value), seed)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def list_hash(values):
    seed = 42
    for v in values:
        seed = long_hash(v, seed)
    return signed(seed)


def int_seeded(value, seed):
    """xxhash64(value, seed) as Spark chains its columns."""
    return signed(xxhash.xxh64_intdigest(struct.pack("<q", seed), long_hash(value)))


def imatch_print(words, lexicon):
    terms = {signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words}
    common = sorted(terms & lexicon)
    out = [list_hash(common or sorted(terms)) if terms else 0]
    for seed in range(imatch.SUBSETS):
        drawn = [int_seeded(t, seed) for t in common]
        for level in imatch.LEVELS:
            kept = [h for h in drawn if h & ((1 << level) - 1) == 0]
            out.append(list_hash(kept) if kept else 0)
    return out


def alike(one, other):
    if one == other:
        return 1.0
    best = 0.0
    for at in range(len(imatch.LEVELS)):
        pairs = [(a, b) for i, (a, b) in enumerate(zip(one, other)) if i and (i - 1) % len(imatch.LEVELS) == at]
        live = [(a, b) for a, b in pairs if a or b]
        if len(live) >= imatch.LIVE:
            best = max(best, sum(a == b for a, b in live) / len(live))
    return best


def test_fingerprints_of_the_whole_table(spark):
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    seen = Counter(w for _, t in rows for w in {w for w in plain_words(t) if w})
    lexicon = {signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w, n in seen.items()
               if imatch.LEAST_IDF <= np.log(len(rows) / n) <= imatch.MOST_IDF}
    got = {r["doc_id"]: r for r in QUERIES["op7_fingerprint_documents"](spark, SF).collect()}
    texts = [t for _, t in rows]
    edited = [t[:len(t) - len(t) // 4] + n[:len(t) // 4] for t, n in zip(texts, texts[1:] + texts[:1])]
    prints = [imatch_print([w for w in plain_words(t) if w], lexicon) for t in texts]
    changed = [imatch_print([w for w in plain_words(t) if w], lexicon) for t in edited]
    shown = lambda p: "".join(f"{h & 0xFFFFFFFF:08x}" for h in p)
    for i, (key, text) in enumerate(rows):
        r = got[key]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited[i].encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(prints[i]), shown(changed[i]))
        assert r["near_edited"] == pytest.approx(alike(prints[i], changed[i]))
        assert r["near_next"] == pytest.approx(alike(prints[i], prints[(i + 1) % len(rows)]))


def test_fingerprints_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "abcd efgh", 0), (7, "q " * 40000, 0), (7, "q", 0)],
                                 "doc_id long, text string, bucket int")
    rows = imatch.edited_fingerprints(docs).collect()
    got = {(r["doc_id"], r["n_chars"]): r["edited"] for r in rows}
    assert got[None, 9] == "abcd ef" and got[1, 0] == "" and got[2, 0] == ""
    assert len(rows) == 5 and got.keys() == {(None, 9), (1, 0), (2, 0), (7, 80000), (7, 1)}
    alone = imatch.edited_fingerprints(docs.where("text like 'abcd%'")).collect()
    assert [r["edited"] for r in alone] == ["abcd efab"]
    assert alone[0]["near_next"] == 1.0
    assert imatch.edited_fingerprints(docs.limit(0)).collect() == []


# --- toxicity ----------------------------------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    scored = QUERIES["op5_score_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    clean = [r["score"] for r in rows if r["toxic"] == 0]
    better = sum((a > b) + (a == b) / 2 for a in toxic for b in clean)
    assert better / (len(toxic) * len(clean)) > 0.85
    assert np.mean([s >= 0.5 for s in toxic]) > 0.5 and np.mean([s >= 0.5 for s in clean]) < 0.02
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_of_odd_rows(spark):
    toxic = [f"you are a rotten zorgblat {w} and again zorgblat indeed zorgblat".encode() for w in "abcdefghijklmnopqrstuvwxyz" for _ in "12"]
    plain = [f"this is a {w} text about nothing in particular and more of it {w * 3}".encode() for w in "abcdefghijklmnopqrstuvwxyz"]
    model = toxicity.fit(toxic, plain)
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "ZORGBLAT zorgblat! " * 3000, 0.5), (3, "x" * 5000, 0.5)],
                                 "doc_id long, text string, score double")
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0]["score"] == rows[1]["score"]
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score_toxicity(docs.limit(0), model).collect() == []
    unlabelled = spark.createDataFrame([], "doc_id long, toxic int")
    nothing = toxicity.train_toxicity(docs, unlabelled)
    assert toxicity.score_toxicity(docs, nothing).count() == 4


def test_labels_of_the_held_out_fold_are_not_looked_at(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (toxicity.train_toxicity(docs, frame) for frame in (labels, flipped))
    assert one.toxic == other.toxic and np.array_equal(one.weights, other.weights)


# --- the pipeline ------------------------------------------------------------------------------------

def test_pipeline_equals_its_operators_by_brute_force(spark):
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train_toxicity(docs, labels)
    texts = {i: r["text"] or "" for i, r in rows.items()}
    scores = dict(zip(texts, model.scores(toxicity.text_figures([t.encode() for t in texts.values()], model.toxic, model.ordinary))))
    texts = {i: t for i, t in texts.items() if scores[i] < 0.5}
    kept = kept_by_all_pairs(texts)
    texts = {i: t for i, t in texts.items() if i in kept}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {i: c for i, c in contamination(texts.items(), items).items() if c[4]}
    # What reaches the mix: all but the documents that are mostly benchmark passages.
    staged = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        staged = materialize(stage(spark, staged, SF), "staged")
    mostly = {i for i, c in hit.items() if 2 * c[1] > c[0]}
    before_mix = {r["doc_id"]: r["text"] for r in staged.collect()}
    assert set(before_mix) == set(texts) - mostly
    assert {i for i, t in before_mix.items() if i not in hit and not pii.base_spans(texts[i]) and "[" not in t
            and t != texts[i]} == set()
    assert set(got) <= set(before_mix) and all(r["text"] == before_mix[i] for i, r in got.items())
    for i, r in got.items():
        assert contamination([(i, r["text"])], items)[i][1] == 0  # no passage is left
        assert pii.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
        if i not in hit and not pii.base_spans(texts[i]) and "[" not in r["text"]:
            assert r["text"] == texts[i]
    clean = {i for i in texts if i not in hit}
    taken = Counter()
    for r in got.values():
        assert 0 < r["taken"] <= 3 * r["size"] == 3 * len(r["text"].encode().split())
        taken[r["source"]] += r["taken"]
    for r in got.values():
        assert abs(taken[r["source"]] - r["target"]) <= max(3, 0.01 * r["target"])
    # A document is only missing if the mix took no word of it.
    mixed = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(staged).collect()}
    assert set(got) == {i for i, n in mixed.items() if n > 0} and clean <= set(mixed)


def test_stages_of_empty_and_odd_tables(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "words of a text", "en", None, 15),
            (9, "long " * 50000, "en", "s", 250000)]
    for docs in (spark.createDataFrame([], schema), spark.createDataFrame(rows, schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
            assert stage(spark, docs, SF).count() <= docs.count()
        assert corpus_pipeline.mix(spark, docs, SF).count() <= docs.count()


def test_whole_licenses_as_templates(spark):
    """A notice of 300 words, found whole, with a tenth changed, but not when a fifth is missing."""
    rng = np.random.default_rng(12)
    words = [f"w{n}" for n in range(300)]
    changed = list(words)
    for at in rng.choice(300, 25, replace=False):
        changed[at] = "other"
    filler = lambda n: [f"f{k}" for k in rng.integers(0, 50, n)]
    texts = {1: filler(431) + words + filler(90), 2: filler(40) + changed, 3: filler(20) + words[:230] + filler(40),
             4: filler(900), 5: "proprietary and confidential all rights reserved".split(), 6: words * 3}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    notices = [("long", " ".join(words)), *licenses.NOTICES]
    found, links = licenses.scan_licenses(docs, notices)
    assert {r["doc_id"]: r["labels"] for r in found.collect()} == {
        1: "long", 2: "long", 3: "", 4: "", 5: "proprietary", 6: "long"}
    for r in links.collect():
        block = texts[r["doc_id"]][r["block"] * r["step"]:][:2 * r["step"]]
        notice = set(notices[r["notice"]][1].split())
        assert r["containment"] == pytest.approx(len(notice & set(block)) / len(notice)) and r["containment"] >= 0.9
    assert {r["step"] for r in links.collect()} == {32, 512}
