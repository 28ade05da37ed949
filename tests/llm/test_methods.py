"""Each method against a plain version: random graphs, flows, hot groups, crowded buckets."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeshelf.llm import language, mixing, near_text, near_vectors, quality, secret_scan, stored, vector_search
from lakeshelf.llm import components as module
from lakeshelf.llm.components import components
from lakeshelf.llm.words import NOT_ALNUM, Words, window_hashes

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    stored.ship_package(spark)


def reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- words ------------------------------------------------------------------------------------


def test_words_of_odd_texts():
    texts = ["a  b\tc", "", None, "\n\n", "é漢 x\x85y", "A1-b", "a"]
    for chunk in (pa.array(texts), pa.array(["drop", *texts]).slice(1)):
        words = Words(chunk)
        assert [words.words.to_pylist()[a:b] for a, b in zip(words.first, words.first[1:])] == [
            [b"a", b"b", b"c"], [], [], [], ["é漢".encode(), "x\x85y".encode()], [b"A1-b"], [b"a"],
        ]
        hashes = words.hashes()
        assert hashes[0] == hashes[-1] and len(set(hashes.tolist())) == 6
    split = Words(pa.array(texts), NOT_ALNUM, lower=True)
    assert split.words.to_pylist()[-3:] == [b"a1", b"b", b"a"]


def test_hashes_do_not_depend_on_the_batch():
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choices("ab", k=rnd.randint(1, 9))) for _ in range(200)) for _ in range(20)]
    whole = Words(pa.array(texts))
    of = dict(zip((whole.vocabulary[i] for i in whole.ids), whole.hashes().tolist()))
    assert len(set(of.values())) == len(of)
    for text in texts:
        part = Words(pa.array([text]))
        assert [of[part.vocabulary[i]] for i in part.ids] == part.hashes().tolist()
    a, b = (Words(pa.array([t])) for t in ("x y z", "z y x"))
    assert window_hashes(a.hashes(), np.array([0]), 3) != window_hashes(b.hashes(), np.array([0]), 3)


# --- components -------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(-60, 60), rnd.randrange(-60, 60)) for _ in range(50)]
    links += [(100, 101 + i) for i in range(200)] + [(500 + i, 501 + i) for i in range(90)]  # a star and a long chain
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    nodes = {n for a, b in links for n in (a, b) if a != b}
    assert {r.id: r.component for r in got} == {n: c for n, c in reachable(nodes, links).items()} and len(got) == len(nodes)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_in_rounds(spark, monkeypatch):
    """Tasks that contract nothing leave all work to the rounds."""
    monkeypatch.setattr(module, "_contracted", lambda edges: edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (100, 95), (95, 200)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in got} == reachable({n for link in links for n in link}, links)


# --- mixing -----------------------------------------------------------------------------------


def test_targets():
    assert mixing.targets_by_weight([10, 10, 10], [5, 2, 1]) == [18.75, 7.5, 3.75]
    # The first may have 3 only, which leaves 28 to be shared 2 : 1.
    assert mixing.targets_by_weight([1, 10, 20], [5, 2, 1]) == [3.0, 28 * 2 / 3, 28 / 3]
    assert mixing.targets_by_weight([0, 0], [5, 2]) == [0.0, 0.0]


def best_cost(capacity, members, quota, repeats):
    """Largest amount, then least cost, by trying all amounts."""
    best = (0, 0)
    for taken in itertools.product(*(range(repeats * c + 1) for c in capacity)):
        reach = {tuple([0] * len(quota))}
        for t, own in zip(taken, members):
            reach = {
                tuple(x + n for x, n in zip(r, split))
                for r in reach
                for split in itertools.product(*(range(t + 1) if s in own else (0,) for s in range(len(quota))))
                if sum(split) == t and all(x + n <= q for x, n, q in zip(r, split, quota))
            }
        if reach:
            cost = sum((u // c) * (u // c + 1) // 2 for t, c in zip(taken, capacity) for u in range(t))
            best = min(best, (-sum(taken), cost))
    return best


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_largest_and_cheapest(seed):
    rnd = random.Random(seed)
    capacity = [rnd.randint(1, 3) for _ in range(3)]
    members = [sorted(rnd.sample(range(3), rnd.randint(1, 3))) for _ in range(3)]
    quota = [rnd.randint(0, 5) for _ in range(3)]
    taken = mixing.route(capacity, members, quota, 2)
    cost = sum((u // c) * (u // c + 1) // 2 for t, c in zip(taken, capacity) for u in range(t))
    assert (-sum(taken), cost) == best_cost(capacity, members, quota, 2)


def test_mix_of_overlapping_sources(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(1, 50), rnd.choice([["a"], ["b"], ["a", "b"], ["b", "a", "b"], ["c"], [None]])) for i in range(3000)]
    sized = spark.createDataFrame(rows, "doc_id bigint, size bigint, sources array<string>")
    out = [r.asDict() for r in mixing.mix(sized).collect()]
    assert sorted(r["doc_id"] for r in out) == list(range(3000))
    again = mixing.mix(sized.repartition(7)).collect()
    assert Counter((r.doc_id, r.copies) for r in again) == Counter((r["doc_id"], r["copies"]) for r in out)
    # Sources without overlap: taken words come within a document of the target.
    for name in ("c", None):
        own = [r for r in out if r["sources"] == [name]]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["targets"][0]) <= 26
    shared = [r["copies"] for r in out if len(set(r["sources"])) > 1]
    assert max(shared) - min(shared) <= 1  # repeats are spread evenly


def test_second_bucket_and_edge_are_exact(spark, monkeypatch):
    """Two buckets a level put many documents into the one that is sorted."""
    monkeypatch.setattr(mixing, "BITS", 1)
    sized = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("size"), F.array(F.lit("s")).alias("sources"))
    sized = sized.unionByName(spark.range(1000, 1003).select(F.col("id").alias("doc_id"), F.lit(400).cast("bigint").alias("size"), F.array(F.lit("t")).alias("sources")))
    out = mixing.mix(sized).withColumn("at", mixing.seeded("doc_id", 0)).where("sources[0] = 't'").collect()
    before, want = 0, round(out[0].targets[0])
    total = out[0].source_sizes[0]
    for r in sorted(out, key=lambda r: r["at"]):
        assert r.copies == want // total + int(want % total > 0 and 2 * before + r.size <= 2 * (want % total))
        before += r.size


# --- language and quality ---------------------------------------------------------------------


def test_probabilities_sum_to_one():
    rnd = random.Random(1)
    texts = {lang: " ".join("".join(rnd.choices(letters, k=rnd.randint(1, 5))) for _ in range(300)) for lang, letters in (("x", "abc"), ("y", "bcd"))}
    strings = {}
    for lang, text in texts.items():
        keys, n = language._added(language.keys_of(pa.array([text]))[0])
        strings[lang] = keys, n.astype(float)
    model = language.build_model(strings)
    alphabet = np.array([0, *map(ord, "abcd")], np.int64)
    for context in ("abca", "dddd", " a b", "zzzz"):
        head = 0
        for c in context:
            head = (head << language.BITS | (ord(c) if c != " " else 0)) & ((1 << 60) - 1)
        grams = (head << language.BITS & ((1 << 60) - 1)) | alphabet
        known = np.exp(model.position_scores(grams).astype(np.float64)).sum(axis=0)
        unseen = np.exp(model.position_scores(np.array([(head << language.BITS & ((1 << 60) - 1)) | 999]))[0].astype(np.float64))
        assert np.allclose(known + unseen, 1, atol=1e-4)


def plain_kneser_ney(texts):
    """Log-probability of a symbol after four others by one language's ``texts``, from dictionaries; and the symbols seen."""
    levels = {5: Counter(g for t in texts for g in strings_of(t))}
    for order in (4, 3, 2, 1):
        levels[order] = Counter(g[1:] for g in levels[order + 1])
    sums, kinds, discounts = {}, {}, {}
    for order, counts in levels.items():
        ones, twos = (sum(n == x for n in counts.values()) for x in (1, 2))
        discounts[order] = ones / (ones + 2 * twos) if ones and twos else 0.5
        sums[order], kinds[order] = Counter(), Counter(g[:-1] for g in counts)
        for g, n in counts.items():
            sums[order][g[:-1]] += n

    def probability(gram, unknown):
        if not gram:
            return unknown
        order, head, lower = len(gram), gram[:-1], probability(gram[1:], unknown)
        if not sums[order][head]:
            return lower
        own = max(levels[order][gram] - discounts[order], 0) if gram in levels[order] else 0
        return (own + discounts[order] * kinds[order][head] * lower) / sums[order][head]

    return probability, set(levels[1])


def strings_of(text):
    letters = re.sub(r"[^a-zäöü]+", " ", text.lower())
    return [("    " + letters)[i : i + 5] for i in range(len(letters))]


def test_language_equals_plain_kneser_ney_over_many_shards(spark, monkeypatch):
    rnd = random.Random(5)
    words = {lang: ["".join(rnd.choices(letters, k=rnd.randint(1, 6))) for _ in range(80)] for lang, letters in (("x", "abcde"), ("y", "cdefä"), ("z", "aeöü"))}
    rows = [(i, " ".join(rnd.choices(words["xyz"[i % 3]], k=rnd.randint(1, 60))), "xyz"[i % 3]) for i in range(150)]
    rows += [(1000, "b" * 400 + " qqq", None), (1001, "Ä1ö", None), (1002, "", None), (1003, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    monkeypatch.setattr(language, "CELLS", 500)
    monkeypatch.setattr(language, "PART", 2000)
    learned = language.train(docs)
    assert learned.n_strings * 3 > 4 * language.CELLS  # several shards, and parts that ask apart
    got = {r.doc_id: r for r in language.score(docs.select("doc_id", F.struct("text", "lang").alias("s")), learned, text="s.text", spread="doc_id").collect()}
    models = {lang: plain_kneser_ney([t for _, t, own in rows if own == lang]) for lang in "xyz"}
    unknown = 1 / (len(set.union(*(seen for _, seen in models.values()))) + 1)
    assert got.keys() == {r[0] for r in rows}
    for doc_id, text, lang in rows:
        r, grams = got[doc_id], strings_of(text or "")
        assert (r.s.text, r.s.lang) == (text, lang)
        if not any(g[-1] != " " for g in grams):
            assert (r.lang_pred, r.score, r.entropy, r.n_symbols) == ("und", 0, None, 0)
            continue
        nats = {name: -sum(np.log(p(g, unknown)) for g in grams) / len(grams) for name, (p, _) in models.items()}
        best = min(nats, key=nats.get)
        assert r.n_symbols == len(grams) and r.lang_pred == best and abs(r.entropy - nats[best]) < 1e-4


def test_wrong_labels_do_not_loosen_the_rejection(spark):
    rows = [(i, "x", 1.0 + i % 10 / 100, 100, "x", "calibrate") for i in range(300)]
    wrong = [(1000 + i, "y", 5.0, 100, "x", "calibrate") for i in range(100)]
    schema = "doc_id bigint, lang string, entropy double, n_symbols bigint, lang_pred string, use string"
    out = language.with_rejection(spark.createDataFrame(rows + wrong + [(5000, None, 4.0, 100, "x", None)], schema)).collect()
    assert {r.doc_id for r in out if r.rejected} == {r[0] for r in wrong} | {5000}


def test_noise_is_rejected_and_clean_text_is_not(spark):
    rnd = random.Random(2)
    words = {lang: ["".join(rnd.choices(letters, k=rnd.randint(2, 7))) for _ in range(60)] for lang, letters in (("x", "aeioulnrst"), ("y", "äöükpmgdfh"))}
    rows = [(i, " ".join(rnd.choices(words["xy"[i % 2]], k=rnd.randint(3, 80))), "xy"[i % 2]) for i in range(600)]
    rows += [(1000 + i, "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(60)), None) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("use", language.use("doc_id", "lang"))
    model = language.train(docs.where("use = 'fit'"))
    out = language.with_rejection(stored.stored(language.score(docs, model), "scored")).collect()
    assert all(r.rejected == (r.doc_id >= 1000) for r in out)
    assert all(r.lang_pred == r.lang for r in out if r.doc_id < 1000)


def test_quality_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (2, 5) in model.pairs
    assert ((model(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


# --- near duplicates --------------------------------------------------------------------------


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def text_classes(texts):
    sets = {}
    for i, text in texts.items():
        words = plain_words(text.translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return reachable(texts, links)


def test_hot_group_of_near_copies(spark):
    """A third of the documents are near copies of one text; some are only just near to a single one of them."""
    rnd = random.Random(4)

    def prose(n):
        return [f"w{rnd.randrange(10**6)}" for _ in range(n)]

    def changed(words, n):
        words = list(words)
        for at in rnd.sample(range(len(words)), n):
            words[at] = f"c{rnd.randrange(10**6)}"
        return words

    base, texts = prose(240), []
    texts += [changed(base, rnd.randint(0, 7)) for _ in range(400)]
    edge = [changed(base, 6) for _ in range(40)]
    texts += edge + [words[:-20] + prose(6) for words in edge]
    for _ in range(120):
        own = prose(rnd.randint(20, 120))
        texts += [own] + [changed(own, rnd.randint(0, 3)) for _ in range(rnd.randint(0, 3))]
    rnd.shuffle(texts)
    docs = {i: " ".join(words) for i, words in enumerate(texts)}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_text.near_duplicates(df).collect()}
    assert got == text_classes(docs)


def test_crowded_regions_are_searched_again(spark, monkeypatch):
    """With one neighbour a side only, the later rounds still find what joins components."""
    monkeypatch.setattr(near_text, "NEAR", 1)
    monkeypatch.setattr(near_text, "MOST", 2)
    rnd = random.Random(6)
    shared = [f"s{i}" for i in range(60)]
    texts = []
    for _ in range(40):  # many documents that share a passage, in pairs that belong together
        own = shared + [f"w{rnd.randrange(10**6)}" for _ in range(60)]
        texts += [own, own[:-3] + ["x", "y", str(rnd.random())]]
    docs = {i: " ".join(words) for i, words in enumerate(texts)}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_text.near_duplicates(df).collect()}
    assert got == text_classes(docs)


def test_crowded_bucket_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(24)
    x = np.vstack([centre + 0.22 * rng.standard_normal((150, 24)), rng.standard_normal((150, 24))]).astype(np.float32)
    x = np.vstack([x, x[:40]])  # copies
    label = rng.integers(0, 2, len(x)) * (np.arange(len(x)) >= 150)
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))], "vec_id bigint, embedding array<float>, label int")
    y = x.astype(np.float64)
    n = np.sqrt((y * y).sum(1))
    near = ((y @ y.T) / (n[:, None] * n) >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    want = reachable(range(len(x)), list(zip(*np.nonzero(near))))
    got = near_vectors.near_vectors(df).collect()
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate(near.sum(axis=1)))
    assert {r.vec_id: r.component_id for r in got} == {i: int(c) for i, c in want.items()}


def test_search_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "ROWS", 300)
    monkeypatch.setattr(vector_search, "QUERIES", 20)
    rng = np.random.default_rng(9)
    x = (rng.standard_normal((1500, 32)) * rng.uniform(0.2, 3, (1500, 1))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    found = defaultdict(set)
    for r in vector_search.search(df, F.col("vec_id") % 20 == 0).collect():
        found[r.query_id].add(r.vec_id)
    y = x.astype(np.float64)
    hits = 0
    for q in range(0, 1500, 20):
        scores = y @ y[q]
        scores[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-scores)[:20].tolist()))
    assert hits >= 0.97 * 20 * 75


# --- pipeline ---------------------------------------------------------------------------------


def test_pipeline_stages_do_their_work(spark):
    docs = stored.read_table(spark, SF_DIR, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored.stored(stage(spark, docs, SF_DIR), name)
        kept[name] = before, docs
    before, after = ({r.doc_id: r for r in df.collect()} for df in kept["language"])
    assert len(after) >= 0.97 * len(before) and all(before[i] == r for i, r in after.items())
    before, after = ({r.doc_id: r for r in df.collect()} for df in kept["near_text"])
    classes = text_classes({i: r.text for i, r in before.items()})
    assert {i for i in before if classes[i] == i} == set(after) and all(before[i] == r for i, r in after.items())
    before, after = ({r.doc_id: r for r in df.collect()} for df in kept["secrets"])
    assert before.keys() == after.keys()
    rows, _ = secret_scan.scan_versions(kept["secrets"][0].withColumnRenamed("doc_id", "path"))
    found = {r.path: r.found for r in rows.collect()}
    assert any(found.values())
    for i, r in after.items():
        text, out, at = before[i].text, "", 0
        for s in found[i] or []:
            out += text[at : s.start] + "[secret]" * (s.start >= at)
            at = max(at, s.end)
        assert r.text == out + text[at:]
        assert r.n_chars == (len(r.text) if found[i] else before[i].n_chars)
    before, after = ([r for r in df.collect()] for df in kept["mixing"])
    copies = Counter(r.doc_id for r in after)
    sizes, words = Counter(), Counter()
    for r in before:
        sizes[r.source] += len(plain_words(r.text))
        words[r.source] += copies[r.doc_id] * len(plain_words(r.text))
    names = sorted(sizes)
    targets = mixing.targets_by_weight([sizes[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    longest = max(len(plain_words(r.text)) for r in before)
    assert max(copies.values()) <= 3 and all(abs(words[n] - t) <= longest / 2 + 1 for n, t in zip(names, targets))
    packed = Counter(r.doc_id for r in kept["packing"][1].where("start = 0").collect())
    assert packed == copies
    assert corpus_pipeline.run(spark, SF_DIR).columns == kept["packing"][1].columns
