"""Operators against brute force, round trips and edge cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from obswatch.llm import classifier, common, flac, language, maxent, neardup, packing, pieces, rules, sharding, textstats, warc
from obswatch.llm.common import components, written

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(400)]


def some_texts():
    r = random.Random(5)
    text = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    base = [text(r.randint(30, 120)) for _ in range(12)]
    near = [" ".join([*b.split()[:-3], "end"]) for b in base[:6]]
    return [None, "", " \n", "one two", "one two", "x" * 30_000, text(20_000), *base, *near, *base[:4], *base[:4], "ümläut ﬀ 日本 🙂", "Ein Satz\nEin Satz\n"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i % 9 else None, t, "en" if i % 3 else None, "s", i % 2, "clash") for i, t in enumerate(some_texts())]
    rows += rows[3:8]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, quality int, score string").repartition(5)


def shingles(t):
    w = (t or "").encode().split()
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def classes_by_brute_force(rows):
    texts = sorted({t or "" for _, t in rows})
    sets = [shingles(t) for t in texts]
    root, links = list(range(len(texts))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for k, t in rows:
        c = find(texts.index(t or ""))
        if k is not None:
            least[c] = min(least.get(c, k), k)
    return Counter((k, least.get(find(texts.index(t or ""))), links[texts.index(t or "")]) for k, t in rows)


def test_join_equals_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for block in (256, 3):
        got = neardup.join(docs, block=block).collect()
        assert Counter((r["key"], r["class_id"], r["n_links"]) for r in got) == classes_by_brute_force(rows)
    assert neardup.join(docs.limit(0)).count() == 0


def test_join_of_a_dense_group_in_blocks(spark):
    r = random.Random(1)
    base = [r.choice(WORDS) for _ in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        w[r.randrange(200)] = f"z{i}"
        rows.append((i, " ".join(w)))
    got = neardup.join(spark.createDataFrame(rows, "doc_id long, text string"), block=8).collect()
    assert Counter((x["key"], x["class_id"], x["n_links"]) for x in got) == classes_by_brute_force(rows)


def test_depth_meets_the_target():
    d = neardup.shortest_depth(0.8, 24, 8, 0.9995)
    assert 1 - (1 - 0.8**d) ** 24 >= 0.9995 > 1 - (1 - 0.8 ** (d + 1)) ** 24
    assert neardup.recall_estimate({}, 8, 24) == 1.0 and neardup.recall_estimate({100: 5}, 8, 24) == 1.0
    assert abs(neardup.recall_estimate({80: 1000}, 8, 24) - (1 - (1 - 0.8**8) ** 24)) < 1e-9


def _variants(n, words, seed=1):
    """Texts of one chain: each differs from the one before in a word."""
    r = random.Random(seed)
    text = [r.choice(WORDS) for _ in range(words)]
    out = []
    for i in range(n):
        text = list(text)
        text[r.randrange(words)] = f"v{seed}x{i}"
        out.append(" ".join(text))
    return out


def test_prefixes_are_shortened_until_the_target(spark, monkeypatch):
    """Near the threshold shorter prefixes are needed; pairs are met once, whatever the round and the place."""
    r = random.Random(6)
    base = [r.choice(WORDS) for _ in range(120)]
    rows, far = [], []
    for i in range(40):
        w = list(base)
        for at in r.sample(range(0, 120, 6), 2):
            w[at] = f"z{i}q{at}"
        rows.append((i, " ".join(w)))
    depths = []
    real = neardup.meetings
    monkeypatch.setattr(neardup, "meetings", lambda forest, depth, *a: depths.append(depth) or real(forest, depth, *a))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.join(df).collect()
    assert depths == list(range(8, depths[-1] - 1, -1)) and depths[-1] < 8
    assert Counter((x["key"], x["class_id"], x["n_links"]) for x in got) == classes_by_brute_force(rows)
    depths.clear()
    far = [(i, t + (" tail" if i % 2 else "")) for i, t in enumerate(_variants(1, 300) * 2)]
    neardup.join(spark.createDataFrame(far, "doc_id long, text string")).collect()
    assert depths == [8]


def test_a_chained_group_is_sent_by_prefixes(spark):
    """A long chain of candidates is one connected group; its texts are sent a bounded number of times each."""
    rows = list(enumerate(_variants(160, 60)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (4, 256):
        got = neardup.join(df, block=block).collect()
        assert Counter((x["key"], x["class_id"], x["n_links"]) for x in got) == classes_by_brute_force(rows)
    signed = written(neardup.signed(df, "doc_id", "text", 24, 8))
    from pyspark.sql import functions as F

    forest = written(signed.select("node", "size", F.lit("one").alias("place"), "paths"))
    sent = neardup.meetings(forest, 8, 8, 4)
    assert sent.where("tree >= 0").count() == sent.count() < 160 * 40  # whole, each text would be sent 40 times


def test_null_ids_keep_their_classes_apart(spark):
    rows = [(None, "one text of a few words here"), (None, "quite another thing that is said"), (None, "one text of a few words here")]
    got = neardup.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({x["class_key"] for x in got}) == 2 and all(x["class_id"] is None for x in got)


def test_stage_keeps_one_of_each_class(spark, docs):
    kept = neardup.stage(spark, docs, SF)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {c for _, c, _ in classes_by_brute_force(rows)}
    got = [r["doc_id"] for r in kept.collect()]
    assert {g for g in got if g is not None} == {w for w in want if w is not None} and len(got) == len(set(got))


def test_components(spark):
    r = random.Random(3)
    pairs = [(i, i + 1) for i in range(40)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(50)]
    pairs = [(min(p), max(p)) for p in pairs if p[0] != p[1]]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    group = {n: {n} for p in pairs for n in p}
    for a, b in pairs:
        union = group[a] | group[b]
        for n in union:
            group[n] = union
    assert got == {n: min(g) for n, g in group.items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_base(t):
    t = t or ""
    words = t.encode().split()
    covered = set()
    seen = defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {a + k for a in at for k in range(8)}
    lines = t.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if x.encode().split() and x in lines[:i])
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_base_counts():
    r = random.Random(2)
    texts = [*some_texts(), "a b c d e f g h " * 3, "a b\n a b\na b\n\n\n#$%", " ".join(r.choice("ab") for _ in range(200)), "\x0b\x0c\r x y z"]
    for t in texts:
        assert textstats.base(t)[:5] == brute_base(t)


def test_exact_bounds():
    assert abs(rules.upper_bound(0, 100, 0.05) - (1 - 0.05 ** (1 / 100))) < 1e-9
    p = rules.upper_bound(3, 50, 0.01)
    from math import comb

    assert abs(sum(comb(50, i) * p**i * (1 - p) ** (50 - i) for i in range(4)) - 0.01) < 1e-9
    assert rules.upper_bound(5, 5, 0.1) == 1.0


def test_rules_judge(spark, docs):
    r = random.Random(9)
    good = [(i, " ".join(r.choice(WORDS) for _ in range(60)), "en") for i in range(4000)]
    junk = [(i, " ".join(r.choice(WORDS) + "%%%" for _ in range(60)), "en") for i in range(4000, 4100)]
    labels = spark.createDataFrame([(i, 1) for i, *_ in good] + [(i, 0) for i, *_ in junk] + [(1, 0)], "doc_id long, quality int")
    measured = written(rules.measure(spark.createDataFrame(good + junk, "doc_id long, text string, lang string")))
    kept = {x["doc_id"]: x["kept"] for x in rules.judge(measured, labels).collect()}
    assert not any(kept[i] for i, *_ in junk)
    assert sum(not kept[i] for i, *_ in good) <= 0.02 * len(good)
    edge = written(rules.measure(docs))
    out = rules.judge(edge, labels.limit(0)).collect()
    assert len(out) == docs.count() and all(x["kept"] == (not x["base_failed"]) for x in out)
    assert rules.stage(spark, docs, SF).columns == docs.columns


def test_cutoffs_equal_brute_force(spark):
    """Levels, trials by distinct text, bounds and the choice among levels, one by one."""
    r = random.Random(12)
    texts = {}
    for i in range(3000):
        bad = i % 7 == 0
        words = [r.choice(WORDS) + ("%" * r.randint(1, 3) if r.random() < (0.5 if bad else 0.02) else "") for _ in range(40)]
        texts[i] = (" ".join(words), "en" if i % 3 else None, 0 if bad else 1)
    rows = [(i, t, g) for i, (t, g, _) in texts.items()] + [(5000 + i, texts[1][0], "en") for i in range(500)]  # copies are one trial
    labels = [(i, q) for i, (_, _, q) in texts.items()] + [(5000 + i, 1) for i in range(500)]
    measured = written(rules.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    got = {x["doc_id"]: x["kept"] for x in rules.judge(measured, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    import hashlib
    from math import ceil

    at = [textstats.FEATURES.index(n) for n in rules.RULES]
    trials = {}
    quality = dict(labels)
    for i, t, g in rows:
        values = [textstats.features(t)[1][k] for k in at]
        if not (textstats.base(t)[0] < 20 or 100 * textstats.base(t)[4] > 30 * textstats.base(t)[0]):
            key = (g, t)
            trials[key] = (max(quality[i], trials.get(key, (0,))[0]), values)
    limits = {}
    strata = {g for g, _ in trials}
    for g in strata:
        mine = [(q, v, zlib.crc32(hashlib.md5(t.encode()).hexdigest().encode()) % 2 == 0) for (h, t), (q, v) in trials.items() if h == g]
        train = [v for q, v, test in mine if q and not test]
        best = (-1, 0, None)
        for j, level in enumerate(rules.LEVELS):
            cuts = [sorted(v[k] for v in train)[max(0, ceil((1 - level) * len(train)) - 1)] for k in range(len(at))]
            over = lambda v: any(x > c for x, c in zip(v, cuts, strict=True))  # noqa: E731, B023
            n, k = sum(q and t for q, _, t in mine), sum(bool(q and t and over(v)) for q, v, t in mine)
            if n and rules.upper_bound(k, n, 0.05 / (len(strata) * len(rules.LEVELS))) <= 0.02:
                best = max(best, (sum(not q and over(v) for q, v, _ in mine), j, cuts))
        limits[g] = best[2]
    for i, t, g in rows:
        values = [textstats.features(t)[1][k] for k in at]
        failed = textstats.base(t)[0] < 20 or 100 * textstats.base(t)[4] > 30 * textstats.base(t)[0]
        assert got[i] == (not failed and not (limits[g] and any(x > c for x, c in zip(values, limits[g], strict=True))))
    assert any(limits.values()) and not all(got.values())


def _mixture_by_loops(model, text, rounds=12, penalty=3.0, temper=0.5):
    """Plain EM over one text, with nested sets of languages."""
    bucket, word, _ = language.trigrams([text])
    k = len(model.languages)
    like = np.array([[sum(float(model.table[b, j]) for b in bucket[word == w]) * temper for j in range(k)] for w in range(word.max() + 1)])
    like = np.exp(np.maximum(like - like.max(1, keepdims=True), -60))

    def em(allowed):
        share = np.array([j in allowed for j in range(k)], float) / len(allowed)
        for _ in range(rounds):
            part = share * like
            share = (part / part.sum(1, keepdims=True)).mean(0)
        return share, np.log((share * like).sum(1)).sum()

    order = np.argsort(-em(range(k))[0], kind="stable")
    best, value = np.eye(k)[order[0]], np.log(like[:, order[0]]).sum()
    for m in range(2, k + 1):
        share, fit = em(set(order[:m].tolist()))
        if fit - penalty * (m - 1) * np.log(len(like) + 1) <= value:
            break
        best, value = share, fit - penalty * (m - 1) * np.log(len(like) + 1)
    return best


def test_mixtures_equal_plain_em(spark):
    """Sets may have as many languages as the text: seven here."""
    r = random.Random(3)
    alphabets = ["abcd", "efgh", "ijkl", "mnop", "qrst", "uvwx", "yzßé"]
    word = lambda a: "".join(r.choice(a) for _ in range(r.randint(3, 7)))
    rows = [(i, " ".join(word(alphabets[i % 7]) for _ in range(60)), f"l{i % 7}") for i in range(140)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [" ".join(word(a) for a in alphabets[:m] for _ in range(40)) for m in range(1, 8)] + ["abcd mnop", "a"]
    pred, score, found, shares = language.infer(model, texts)
    for t, p, s, f, x in zip(texts, pred, score, found, shares, strict=True):
        want = _mixture_by_loops(model, t)
        assert abs(s - want.max()) < 1e-6 and p == model.languages[int(want.argmax())]
        assert dict(zip(f, np.round(x, 6), strict=True)) == {model.languages[j]: round(v, 6) for j, v in enumerate(want) if v > 1e-3}
    assert [len(f) for f in found[:7]] == [1, 2, 3, 4, 5, 6, 7]


def test_language_stage(spark):
    """A cutoff from held-out labels drops texts in two languages; columns named as outputs pass through."""
    one, two = "the of and to in is that house ", "der die und das nicht ein haus "
    rows = [(i, one * 5 if i % 2 else two * 5, "en" if i % 2 else "de", "mine", i) for i in range(400)]
    rows += [(i, one * 8 + two * 8, "en" if i % 4 else "de", "mine", i) for i in range(400, 480)] + [(900, None, "en", None, 1), (901, "12 34", "en", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, languages int")
    kept = language.stage(spark, docs, SF)
    got = kept.collect()
    assert kept.columns == docs.columns and {x["doc_id"] for x in got} >= set(range(400)) and all(x["score"] == "mine" and x["languages"] == x["doc_id"] for x in got)
    assert not {900, 901} & {x["doc_id"] for x in got}
    from pyspark.sql import functions as F

    found = spark.createDataFrame([("en", "de", 0.5), ("en", "de", 0.52), ("en", "en", 0.51), ("en", "en", 0.7), ("de", "de", 0.71), ("en", "en", 0.9)], "lang string, lang_pred string, score double")
    assert abs(language.cutoff(found) - 0.55) < 1e-9 and language.cutoff(found.limit(0)) == 0.0
    unknown = language.stage(spark, docs.withColumn("lang", F.lit(None).cast("string")), SF)
    assert unknown.count() == 480


def test_language(spark, docs):
    rows = [(i, "the of and to in is that house " * 5, "en") for i in range(20)] + [(i, "der die und das nicht ein haus " * 5, "de") for i in range(20, 40)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(train)
    pred, score, found, _ = language.infer(model, ["the house and the", "das haus und die", "", None, "123 !!", "the house of and to in is " * 20 + "der die und das nicht ein haus " * 20])
    assert pred[:5] == ["en", "de", "und", "und", "und"] and score[2] == 0.0 and set(found[5]) == {"en", "de"}
    out = language.detect(docs, model)
    assert out.count() == docs.count() and set(docs.columns) - {"score"} <= set(out.columns) and dict(out.dtypes)["score"] == "double"
    none = language.train(train.limit(0))
    assert {x["lang_pred"] for x in language.detect(docs, none).collect()} == {"und"}


def test_classifier(spark, docs):
    measured = written(classifier.measure(docs))
    rows = classifier.labelled(measured.drop("quality"), docs.select("doc_id", "quality"))
    from pyspark.sql import functions as F

    out = classifier.classify(measured, classifier.train(rows, F.col("doc_id") % 3 == 0)).collect()
    assert len(out) == docs.count() and all(0 <= x["score"] <= 1 for x in out)
    none = classifier.classify(measured, classifier.train(rows.limit(0), F.lit(False)))
    assert {x["score"] for x in none.collect()} == {0.5}
    x, y = classifier.rising(np.arange(4.0), np.array([0.2, 0.1, 0.5, 0.4]), np.ones(4))
    assert np.allclose(y, [0.15, 0.45]) and np.allclose(x, [0.5, 2.5])


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.pack(docs).collect()
    by = Counter()
    for x in docs.collect():
        ids = np.array([*t.encode(x["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        start = 0
        for n in packing.cuts(len(ids)):
            by[(x["doc_id"], start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids))] += 1
            start += n
    assert by == Counter((x["doc_id"], x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in rows)
    seqs = defaultdict(list)
    for x in rows:
        seqs[x["sequence_id"]].append((x["offset"], x["length"]))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_plan_covers():
    r = random.Random(4)
    lengths = [*range(64, 2048, 64), *range(1, 64)]
    demand = [r.randint(1, 3000) for _ in lengths]
    got, used, total = Counter(), 0, 0
    for pattern, n in packing.plan(lengths, demand):
        assert sum(k * v for k, v in pattern.items()) <= 2048
        used += n
        for k, v in pattern.items():
            got[k] += v * n
    assert got == Counter(dict(zip(lengths, demand, strict=True)))
    total = sum(a * b for a, b in zip(lengths, demand, strict=True))
    assert used <= total / 2048 * 1.002 + 2


def test_pieces_round_trip(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    m = pieces.model(pieces.model_path())
    plain = pieces.Encoder(pieces.model_path(), 0.0)
    texts = [t or "" for t in some_texts()] + ["a  b", " x ", "a\n\nb", "tab\tq"]
    assert [np.frombuffer(x, "<u4").tolist() for x in plain(texts, [0] * len(texts))] == [sp.encode(t) for t in texts]
    odd = [*texts, "a▁b", "▁", " ▁ "]
    one, two = (pieces.Encoder(pieces.model_path(), 0.2, seed=s)(odd, list(range(len(odd)))) for s in (1, 2))
    assert [pieces.decode_ids(m, x) for x in one] == odd and [pieces.decode_ids(m, x) for x in two] == odd and one != two
    out = pieces.decode(pieces.encode(docs)).collect()
    assert all(x["decoded"] == (x["text"] or "") for x in out) and len(out) == docs.count()


def test_every_occurrence_has_its_own_draws():
    m, e = pieces.model(pieces.model_path()), pieces.Encoder(pieces.model_path(), 0.1)
    for word in ("of", "to", "segmentation"):
        got = e([" ".join([word] * 500)] * 8, list(range(8)))
        k = pieces._keyed(pieces._crcs([f"▁{word}"] * 4000), pieces._occurrences(e.seed, list(range(8)), [500] * 8))
        each = [pieces._long(m, f"▁{word}", int(x), 0.1) for x in k]
        assert got == [b"".join(each[i : i + 500]) for i in range(0, 4000, 500)]
        varied = [x != pieces._long(m, f"▁{word}", 0, 0.0) for x in each]
        assert 0.05 < sum(varied) / 4000 and all(0 < sum(varied[i : i + 500]) < 500 for i in range(0, 4000, 500))
    assert len(set(each)) > 4


def test_branches_give_the_ids_of_single_merging(monkeypatch):
    """Chunks that come often are taken from branches; each must have the ids of its own draws."""
    r = random.Random(7)
    words = ["".join(r.choice("aeinst") for _ in range(r.randint(1, 14))) for _ in range(60)] + ["counting" * 9, "\ue000x"]
    texts = [" ".join(r.choice(words[: 5 + n % 57]) for _ in range(300)) for n in range(40)]
    for most in (400_000, 70):
        monkeypatch.setattr(pieces, "KNOWN", most)
        e = pieces.Encoder(pieces.model_path(), 0.3)
        got = [x for a in range(0, 40, 10) for x in e(texts[a : a + 10], list(range(a, a + 10)))]
        for n, text in enumerate(texts):
            chunks = e.chunks(text)
            keys = pieces._keyed(pieces._crcs(chunks), pieces._occurrences(e.seed, [n], [len(chunks)]))
            assert got[n] == b"".join(e.merged(chunks, keys, 0.3))
        assert most == 70 or max(map(len, e.without)) > 2
    long, e = "counting" * 40, pieces.Encoder(pieces.model_path(), 0.3)
    assert [pieces.decode_ids(e.model, x) for x in e([long, "", None], [1, 2, 3])] == [long, "", ""]
    assert e.merged([], np.zeros(0, np.uint64), 0.3) == []


def test_heap_and_lockstep_agree():
    m, r = pieces.model(pieces.model_path()), random.Random(2)
    for _ in range(100):
        c = "▁" + "".join(r.choice("thereingaboq日é") for _ in range(r.randint(1, 30)))
        k = pieces._keys(3, 1, [c])
        assert pieces._long(m, c, int(k[0]), 0.2) == pieces._short(m, [c], k, 0.2)[0]


def test_flac_round_trip(docs):
    r = random.Random(1)
    payloads = [flac.payload_of(t) for t in some_texts()] + [bytes(64), b"\xff" * 128, r.randbytes(6400), b"\x80" * 63 + b"\xff" + b"\x80" * 960, bytes(int(128 + 100 * np.sin(i / 30)) for i in range(4096))]
    files = flac.encode(payloads)
    assert flac.decode(files) == payloads
    assert flac.read_at(files[6], 1000, 700) == payloads[6][1000:1700]
    broken = bytearray(files[6])
    broken[-40] ^= 4
    with pytest.raises(ValueError):
        flac.decode([bytes(broken)])
    media = flac.stored(docs).select("doc_id", "text", "n_bytes", "media")
    out = flac.features(media.drop("text")).collect()
    assert len(out) == docs.count() and all(x["payload_bytes"] % 64 == 0 for x in out)
    blocks = flac.pcm_blocks(media.where("doc_id = 6").limit(1), "doc_id", 10_000).orderBy("sample_offset").collect()
    text = media.where("doc_id = 6").first()["text"]
    assert bytes(b ^ 0x80 for x in blocks for b in x["pcm"]) == flac.payload_of(text)


def test_warc(spark):
    rows = [(3, "u", "x"), (1, None, "x"), (2, "a b\r\n", "x"), (4, "", None), (5, "v", ""), (None, "w", "x"), (1, "u", "x"), (9, "z", "é" * 3000)]
    pages = spark.createDataFrame([(*x, 1) for x in rows], "page_id long, url string, html string, name int")
    made = warc.archives(pages, archive_bytes=500)
    got = Counter((x["page_id"], x["payload_bytes"], x["record_type"], x["refers_to"]) for x in warc.records(made).collect())
    assert got == Counter({(1, 1, "response", None): 2, (2, 1, "revisit", 1): 1, (3, 1, "revisit", 1): 1, (4, 0, "response", None): 1, (5, 0, "revisit", 4): 1, (None, 1, "response", None): 1, (9, 6000, "response", None): 1})
    assert warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert warc.records(warc.archives(pages.limit(0))).count() == 0
    head, block = warc.parse(warc.record("7", "u", b"\r\n\r\nbody", None))
    assert head["warc-type"] == "response" and block.endswith(b"\r\n\r\n\r\n\r\nbody")


def test_scores(spark, docs):
    from pyspark.sql import functions as F

    rows = docs.withColumn("learn", F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True)))
    got = maxent.score(rows).collect()
    counts = Counter(w for x in rows.collect() if x["learn"] for w in maxent.tokens(x["text"]))
    n, v = sum(counts.values()), len(counts)
    want = Counter((x["doc_id"], len(maxent.tokens(x["text"])), sum(counts[w] > 0 for w in maxent.tokens(x["text"])), round(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in maxent.tokens(x["text"])), 4)) for x in rows.collect())
    assert want == Counter((x["key"], x["n_tokens"], x["n_known"], round(x["base_score"], 4)) for x in got)
    assert all(x["train_tokens"] == n and x["score"] < 0 for x in got)
    assert maxent.score(rows.limit(0)).count() == 0


def _places(words, own):
    """Class and slot of every word, by a dictionary."""
    out = maxent.own_places(own)
    return {w: out.get(w) or (maxent.class_of(w), maxent.slot_of(w)) for w in words}


def _hash(k, bits):
    k &= 0xFFFFFFFF
    for m in (0x85EBCA6B, 0xC2B2AE35):
        k = ((k ^ (k >> (16 if m == 0x85EBCA6B else 13))) * m) & 0xFFFFFFFF
    return (k ^ (k >> 16)) & ((1 << bits) - 1)


def _features(seq, i, place, level, bits):
    """Rows of the features of the i-th token, one by one."""
    import xxhash

    word = lambda j: xxhash.xxh3_64_intdigest(seq[j]) & 0xFFFFFFFF if j >= 0 else 0
    cls = lambda j: place[seq[j]][0] if j >= 0 else maxent.CLASSES
    keys = [word(i - 1), word(i - 2) + 0x51ED270B, (word(i - 1) * 0x9E3779B1 & 0xFFFFFFFF) ^ word(i - 2)]
    if level == 0:
        keys += [cls(i - 1) * 64 + cls(i - 2) + (1 << 20), cls(i - 2) * 64 + cls(i - 3) + (1 << 21)]
    else:
        keys = [((k & 0xFFFFFFFF) ^ (cls(i) * 0x2545F491 & 0xFFFFFFFF)) * 0x9E3779B1 + n for n, k in enumerate(keys)]
    return [_hash(k, bits) for k in keys]


def dense_scores(rows):
    """The model token by token, with dictionaries and whole softmaxes: score by key."""
    texts = [(k, maxent.tokens(t), good, zlib.crc32((t or "").encode()) % maxent.ROUNDS) for k, t, good in rows]
    counts = Counter(w for _, ws, good, _ in texts if good for w in ws)
    own = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: maxent.FREQUENT]]
    place = _places({w for _, ws, _, _ in texts for w in ws}, own)
    mine = set(maxent.own_places(own))
    number = lambda w: int(maxent.cell(np.array([place[w][0]]), np.array([place[w][1]]))[0])
    totals = np.ones(maxent.CELLS)
    for w, c in counts.items():
        totals[number(w)] += c + 1 - (w in mine)
    model = maxent.start(own, totals, sum(counts.values()))

    def chances(seq, i, level, weights):
        c = place[seq[i]][0]
        z = (model.biases[0] if level == 0 else model.biases[1][c]).astype(float) + sum(weights[level][r].astype(float) for r in _features(seq, i, place, level, model.bits))
        z = np.exp(z - z.max())
        return z / z.sum()

    def levels(seq, i):
        return [0] if place[seq[i]][0] < maxent.OWN else [0, 1]

    weights = [w.copy() for w in model.weights]
    for part in [None, *range(maxent.ROUNDS)]:
        seen, expected = ([np.zeros(w.shape) for w in weights] for _ in range(2))
        for _, seq, good, piece in texts:
            for i in range(len(seq)) if good and part in (None, piece) else ():
                for level in levels(seq, i):
                    if part is not None and level != part % 2:
                        continue
                    guess = None if part is None else chances(seq, i, level, weights)
                    for r in _features(seq, i, place, level, model.bits):
                        seen[level][r, place[seq[i]][level]] += 1
                        if part is not None:
                            expected[level][r] += guess
        if part is None:
            expected = [maxent.first_expected(x, model, n) for n, x in enumerate(seen)]
        weights = [maxent.step(w, a, b, (maxent.FIRST_RATE if part is None else maxent.RATE) / f) for w, a, b, (f, _) in zip(weights, seen, expected, maxent.LEVELS, strict=True)]
    return {k: sum(sum(np.log10(chances(seq, i, level, weights)[place[seq[i]][level]]) for level in levels(seq, i)) + np.log10((counts[seq[i]] + 1) / totals[number(seq[i])]) for i in range(len(seq))) for k, seq, _, _ in texts}


def _prose(n):
    r = random.Random(8)
    return [(i, " ".join(r.choice(WORDS[:60]) + r.choice(["", "", "x", "ing"]) for _ in range(r.randint(1, 40))) if i % 11 else None, i % 5 != 0) for i in range(n)]


def test_score_equals_a_dense_model(spark):
    rows = _prose(60)
    want = dense_scores(rows)
    got = {x["key"]: x["score"] for x in maxent.score(spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 * max(1, abs(want[k])) for k in want)


def whole_scores(rows):
    """As dense_scores, but both factors are bettered once more from all training texts."""
    texts = [(k, maxent.tokens(t), good) for k, t, good in rows]
    counts = Counter(w for _, ws, good in texts if good for w in ws)
    own = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: maxent.FREQUENT]]
    place = _places({w for _, ws, _ in texts for w in ws}, own)
    cell_of = {w: int(maxent.cell(np.array([c]), np.array([s]))[0]) for w, (c, s) in place.items()}
    totals = np.ones(maxent.CELLS)
    for w, c in counts.items():
        totals[cell_of[w]] += c + 1 - (w in set(maxent.own_places(own)))
    model = maxent.start(own, totals, sum(counts.values()))

    def chances(seq, i, level, weights):
        z = (model.biases[0] if level == 0 else model.biases[1][place[seq[i]][0]]).astype(float) + sum(weights[level][r].astype(float) for r in _features(seq, i, place, level, model.bits))
        return np.exp(z - z.max()) / np.exp(z - z.max()).sum()

    def levels(seq, i):
        return [0] if place[seq[i]][0] < maxent.OWN else [0, 1]

    weights = [w.copy() for w in model.weights]
    for rate in (maxent.FIRST_RATE, maxent.RATE):
        seen, expected = ([np.zeros(w.shape) for w in weights] for _ in range(2))
        for seq, i, level in ((seq, i, level) for _, seq, good in texts if good for i in range(len(seq)) for level in levels(seq, i)):
            guess = chances(seq, i, level, weights) if rate == maxent.RATE else 0
            for r in _features(seq, i, place, level, model.bits):
                seen[level][r, place[seq[i]][level]] += 1
                expected[level][r] += guess
        if rate == maxent.FIRST_RATE:
            expected = [maxent.first_expected(x, model, n) for n, x in enumerate(seen)]
        weights = [maxent.step(w, a, b, rate / f) for w, a, b, (f, _) in zip(weights, seen, expected, maxent.LEVELS, strict=True)]
    return {k: sum(sum(np.log10(chances(seq, i, level, weights)[place[seq[i]][level]]) for level in levels(seq, i)) + np.log10((counts[seq[i]] + 1) / totals[cell_of[seq[i]]]) for i in range(len(seq))) for k, seq, _ in texts}


def test_op8_learns_every_weight_from_all_training_texts(spark, tmp_path):
    rows = [(k, t, zlib.crc32(str(k).encode()) % 7 != 2) for k, t, _ in _prose(80)]
    spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3).drop("learn").write.parquet(str(tmp_path / "documents.parquet"))
    want = whole_scores(rows)
    got = {x["doc_id"]: x["score"] for x in maxent.op8_lm_scoring(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 * max(1, abs(want[k])) for k in want)


def test_op8_tasks_give_memory_back(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(maxent, "settle", lambda: calls.append(1))

    class Frame:
        """Stands for the documents; keeps what would run as a task."""

        def select(self, *_):
            return self

        def mapInArrow(self, task, _):
            return task

    task = maxent.blocks(Frame(), "k", "t", "g")
    monkeypatch.setattr(maxent.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 0})()))
    assert list(task(iter([]))) == [] and calls == [1]


@pytest.mark.parametrize("bits", [4, 16, 17])
def test_sums_by_row(bits):
    r = np.random.default_rng(bits)
    for n in (0, 1, 31, 33, 5000):
        rows, vectors = r.zipf(1.2, n) % (1 << bits), r.random((n, 32)).astype(np.float32)
        got, want = np.ones((1 << bits, 32)), np.ones((1 << bits, 32))
        maxent.add_rows(got, rows, vectors)
        np.add.at(want, rows, vectors)
        assert np.allclose(got, want, rtol=1e-5)


def test_scores_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(_prose(300), "doc_id long, text string, learn boolean")
    one, many = ({x["key"]: x["score"] for x in maxent.score(df.repartition(n)).collect()} for n in (1, 16))
    assert all(abs(one[k] - many[k]) <= 1e-6 * abs(one[k]) for k in one)


def test_probabilities_sum_to_one():
    r = np.random.default_rng(1)
    w, b = r.normal(size=(1 << 12, 32)).astype(np.float32), np.zeros(32, np.float32)
    assert np.allclose(np.exp(maxent._log_softmax(w, b, r.integers(0, 1 << 12, (5, 50)))).sum(1), 1, atol=1e-4)
    # cells and their words: the shares of all words and of one unseen word for each shared slot
    counts = Counter(f"w{i % 900}".encode() for i in range(9000))
    own = [x for x, _ in counts.most_common(maxent.FREQUENT)]
    place = _places(counts, own)
    totals = np.ones(maxent.CELLS)
    for x, c in counts.items():
        totals[int(maxent.cell(np.array([place[x][0]]), np.array([place[x][1]]))[0])] += c + (x not in maxent.own_places(own))
    assert np.isclose(sum(c + (x not in maxent.own_places(own)) for x, c in counts.items()) + maxent.CELLS, totals.sum())


def test_context_tells_words_of_a_class_apart(spark):
    filler = " ".join(f"f{i}" for i in range(maxent.OWN)) + " "
    rows = [(i, 2 * filler + "aa xing bb ying", True) for i in range(400)] + [(1000, "aa xing bb ying", False), (1001, "aa ying bb xing", False)]
    got = {x["key"]: x["score"] for x in maxent.score(spark.createDataFrame(rows, "doc_id long, text string, learn boolean")).collect()}
    assert maxent.class_of(b"xing") == maxent.class_of(b"ying") and got[1000] > got[1001] + 0.3


def test_tables_follow_the_training_tokens():
    bits = [maxent.start([b"a"], np.ones(maxent.CELLS), n).bits for n in (0, 1 << 26, 1 << 27, 1 << 28, 1 << 29)]
    assert bits == [15, 16, 17, 18, 19]


def test_training_takes_a_block_at_a_time(spark, monkeypatch):
    seen, key = [], common.BATCH_ROWS
    before = spark.conf.get(key, None)
    monkeypatch.setattr(maxent, "written", lambda df: seen.append(df.sparkSession.conf.get(key, None)) or common.written(df))
    assert maxent.score(spark.createDataFrame(_prose(20), "doc_id long, text string, learn boolean"), slices=1).count() == 20
    assert seen.count("1") == 2 and spark.conf.get(key, None) == before


def test_tables_in_files_give_the_dense_scores(spark, monkeypatch):
    """Of 2^18 rows: two slabs, in files of the workers and of the driver."""
    monkeypatch.setattr(maxent, "LEAST_BITS", 18)
    rows = _prose(40)
    want = whole_scores(rows)
    got = {x["key"]: x["score"] for x in maxent.score(spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3), slices=1).collect()}
    assert maxent.start([], np.ones(maxent.CELLS), 1).bits == 18 and isinstance(maxent.zeros(1 << 18, 32), np.memmap)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 * max(1, abs(want[k])) for k in want)


def test_sieve_lets_all_members_through_without_a_shuffle(spark, monkeypatch):
    from pyspark.sql import functions as F

    df = spark.range(4000).select("id", F.concat(F.lit("t"), "id").alias("node"))
    members = df.where("id % 7 = 0")
    for bits in (1 << 26, 1 << 16, 64):  # in the last, all bits are set
        monkeypatch.setattr(common, "SIEVE_BITS", bits)
        by = common.sieve(members, "node")
        hit, miss = common.sifted(df, "node", by), common.sifted(df, "node", by, through=False)
        got, rest = ({r.id for r in x.collect()} for x in (hit, miss))
        assert {r.id for r in members.collect()} <= got and got | rest == set(range(4000)) and not got & rest
        assert hit.columns == df.columns and len(got) < {1 << 26: 580, 1 << 16: 700, 64: 4001}[bits]
        assert "Exchange hashpartitioning" not in hit._jdf.queryExecution().executedPlan().toString()


def test_stage_shuffles_only_doubtful_texts(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(60)]
    rows = [*enumerate(texts), (100, texts[3]), (101, texts[4] + " more"), (None, texts[5])]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        kept = neardup.stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    anti = plan[plan.index("LeftAnti") :]
    assert "sieve_own" in anti[: anti.index("Union")] if "Union" in anti else "sieve_own" in anti


def _shards_by_splitting(rows, limit):
    """Buckets as lists of rows; an oversized one is split on its next bit, until all 60 are used."""
    import hashlib

    hashed = [(int(hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:15], 16), k, len((t or "").encode())) for k, t in rows]
    out, todo = [], [(0, 0, hashed)]
    while todo:
        depth, prefix, mine = todo.pop()
        if sum(n for *_, n in mine) <= limit or depth == sharding.BITS:
            out.append((depth, prefix, mine))
            continue
        for bit in (0, 1):
            part = [x for x in mine if (x[0] >> (sharding.BITS - depth - 1)) & 1 == bit]
            if part:
                todo.append((depth + 1, 2 * prefix + bit, part))
    return out


def test_sharding(spark, tmp_path):
    rows = [(1, "a" * 60)] * 50 + [(2, "b" * 70)] * 3 + [(3, None), (None, "x"), (None, "x" * 500), (4, "y" * 90)] + [(i, "z" * (i % 40)) for i in range(10, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = sharding.assign(docs, limit=130).toPandas()
    assert len(out) == len(rows)
    g = out.groupby("shard_id")
    assert (g.n_bytes.sum() == g.shard_bytes.first()).all() and (g.size() == g.shard_docs.first()).all()
    assert ((g.n_bytes.sum() <= 130) | (g.size() == 1)).all()
    plain = lambda r: sorted((str(k), n, d, p) for d, p, mine in r for _, k, n in mine)
    key = lambda x: None if x != x or x is None else int(x)
    got = sorted((str(key(x.doc_id)), x.n_bytes, x.depth, x.prefix) for x in out.itertuples())
    assert got == plain(_shards_by_splitting(rows, 130))
    again = sharding.assign(docs.repartition(2), limit=130).toPandas()
    same = lambda f: sorted(map(str, f.astype(object).where(f.notna(), None).values.tolist()))
    assert same(again) == same(out)
    assert sharding.assign(docs.limit(0)).count() == 0
    from pyspark.sql import functions as F

    # the directory: every index of so many bits leads to one shard
    few = spark.createDataFrame([(i, "z" * (i % 40)) for i in range(200)], "doc_id long, text string")
    found = sharding.assign(few, limit=300)
    slots = sorted((x["first"], x["last"], x["shard_id"], x["global_depth"]) for x in sharding.directory(found).collect())
    assert all(a[1] < b[0] for a, b in zip(slots, slots[1:])) and slots[-1][1] < 2 ** slots[0][3]
    assert {x[2] for x in slots} == {x["shard_id"] for x in found.collect()} and any(a == b for a, b, *_ in slots)
    # written shards hold what was assigned, with columns of any name
    odd = docs.withColumn("shard_id", F.lit("mine")).withColumn("hash", F.lit(1)).withColumn("row", F.lit(2))
    kept = sharding.write(odd, f"file://{tmp_path}/shards", limit=130)
    back = spark.read.parquet(f"file://{tmp_path}/shards")
    assert back.count() == len(rows) and kept.count() == len(rows) and {"mine"} == {x[0] for x in back.select("shard_id").distinct().collect()}
    size = lambda f: sorted((x["s"], x["n"]) for x in f.groupBy("s").agg(F.sum("n").alias("n")).collect())
    assert size(back.select(F.col("shard").alias("s"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))) == size(kept.select(F.col("shard_id").alias("s"), F.col("n_bytes").alias("n")))


def test_sql_agrees(spark):
    import duckdb

    from obswatch.llm.queries import QUERIES, SQL

    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in SQL.items():
        got = QUERIES[name](spark, SF).toPandas()
        want = c.sql(sql).df()[list(got.columns)]
        assert sorted(map(str, got.astype(object).where(got.notna(), None).values.tolist())) == sorted(map(str, want.astype(object).where(want.notna(), None).values.tolist()))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF))
        assert docs.columns == columns and 0 < docs.count() <= n, name
        n = docs.count()
    last = written(corpus_pipeline.STAGES[-1][1](spark, docs, SF))
    assert {x["doc_id"] for x in last.select("doc_id").collect()} == {x["doc_id"] for x in docs.select("doc_id").collect()}


@pytest.mark.parametrize("name", ["language_id", "quality_rules", "ngram_jaccard_join"])
def test_stages_pass_odd_tables_through(spark, name):
    """Nulls, long texts, ties, repeated rows and columns named as outputs; and empty tables."""
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)[name]
    r = random.Random(4)
    text = " ".join(r.choice(WORDS) + r.choice("abc") for _ in range(60))
    rows = [(1, text, "en", "keep", 7, "x"), (1, text, "en", "keep", 7, "x"), (2, text + " end", None, "keep", 7, "x"), (None, None, "en", "keep", 7, "x"), (3, "", "en", "keep", 7, "x"), (4, "lang " * 300_000, "en", "keep", 7, "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, n_words int, gone_node string")
    odd = odd.withColumnsRenamed({"gone_node": "node"}).selectExpr("*", "score AS kept", "score AS own_n_words", "score AS row", "score AS class_id", "score AS languages", "score AS text_key")
    out = stage(spark, odd, SF)
    got = out.collect()
    assert out.columns == odd.columns and all(x["score"] == "keep" and x["kept"] == "keep" and x["n_words"] == 7 and x["row"] == "keep" for x in got)
    assert {x["text"] for x in got} <= {x[1] for x in rows} and (1 in {x["doc_id"] for x in got})
    assert stage(spark, odd.limit(0), SF).count() == 0


def test_operators_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, ids string, n_pieces int, media string")
    assert rules.measure(none).count() == 0 and language.detect(none, language.train(none)).count() == 0
    assert pieces.encode(none).count() == 0 and flac.stored(none).count() == 0 and packing.stage(spark, none, SF).count() == 0
    measured = written(classifier.measure(none))
    assert measured.count() == 0


class _Writer:
    """Bits of a FLAC frame, written plainly."""

    def __init__(self):
        self.bits = ""

    def put(self, value, n):
        self.bits += format(value & ((1 << n) - 1), f"0{n}b") if n else ""
        return self

    def rice(self, value, k):
        z = 2 * value if value >= 0 else -2 * value - 1
        self.bits += "0" * (z >> k) + "1"
        return self.put(z, k)

    def bytes(self):
        self.bits += "0" * (-len(self.bits) % 8)
        return bytes(int(self.bits[i : i + 8], 2) for i in range(0, len(self.bits), 8))


def _crc(data, poly, bits):
    c = 0
    for x in data:
        c ^= x << (bits - 8)
        for _ in range(8):
            c = (c << 1) ^ (poly if c >> (bits - 1) & 1 else 0) & ((1 << bits) - 1)
            c &= (1 << bits) - 1
    return c


def _flac_frame(number, size, channel_code, subframes):
    """A frame of 16-bit samples; the size is written in 16 bits."""
    head = bytes([0xFF, 0xF8, 0x79, channel_code << 4 | 8]) + chr(number).encode() + (size - 1).to_bytes(2, "big")
    w = _Writer()
    for s in subframes:
        s(w)
    body = head + bytes([_crc(head, 7, 8)]) + w.bytes()
    return body + _crc(body, 0x8005, 16).to_bytes(2, "big")


def _linear(x, order, coefs, shift, bits, wasted=0, parts=0, escape=False, wide=4):
    """A subframe with a linear predictor (or a fixed one, if coefs is None)."""

    def write(w):
        y = [v >> wasted for v in x]
        w.put(0, 1).put(8 + order if coefs is None else 31 + order, 6).put(wasted > 0, 1)
        w.put(1, wasted)
        for v in y[:order]:
            w.put(v, bits - wasted)
        own = coefs if coefs is not None else {2: [2, -1], 4: [4, -6, 4, -1]}[order]
        if coefs is not None:
            w.put(14, 4).put(shift, 5)
            for c in coefs:
                w.put(c, 15)
        w.put(wide - 4, 2).put(parts, 4)
        res = [y[i] - (sum(c * y[i - 1 - j] for j, c in enumerate(own)) >> shift) for i in range(order, len(y))]
        step = len(y) >> parts
        for p in range(1 << parts):
            some = res[max(0, p * step - order) : (p + 1) * step - order]
            if escape and p == 1:
                n = max(v.bit_length() for v in some) + 1
                w.put((1 << wide) - 1, wide).put(n, 5)
                for v in some:
                    w.put(v, n)
            else:
                w.put(3 + p, wide)
                for v in some:
                    w.rice(v, 3 + p)

    return write


def test_streams_of_other_encoders(spark):
    import hashlib

    from obswatch.llm import flacstream

    # the first example of the format's public description, with its checksums
    one = bytes.fromhex("664c6143800000221000100000000f00000f0ac442f0000000013e84b41807dc690307586a3dad1a2e0ffff869180000bf0358fd03128baa9a")
    assert list(flacstream.blocks(one, 4)) == [(0, 1, (25588).to_bytes(2, "little") + (10416).to_bytes(2, "little"))]
    rnd, size = random.Random(3), 64
    wave = lambda a: [int(900 * np.sin(i / 9 + a)) + rnd.randint(-40, 40) for i in range(size)]
    coefs = [9000, -3000, 800, -500, 200, 90, -50, 30, -20, 10, 5, -3]
    parts, want = [], []
    for n, code in enumerate((1, 8, 9, 10)):
        left, right = wave(n), [4 * (v // 4) for v in wave(n + 1)]
        side = [a - b for a, b in zip(left, right, strict=True)]
        mid = [(a + b) >> 1 for a, b in zip(left, right, strict=True)]
        subs = {
            1: [_linear(left, 12, coefs, 13, 16, parts=2), _linear(right, 2, None, 0, 16, wasted=2, parts=1, escape=True)],
            8: [_linear(left, 4, None, 0, 16, parts=3), _linear(side, 12, coefs, 13, 17, parts=1, wide=5)],
            9: [_linear(side, 2, None, 0, 17, parts=1, escape=True, wide=5), _linear(right, 12, coefs, 13, 16)],
            10: [_linear(mid, 2, None, 0, 16), _linear(side, 4, None, 0, 17)],
        }[code]
        parts.append(_flac_frame(n + 126, size, code, subs))
        want += zip(left, right, strict=True)
    raw = b"".join(v.to_bytes(2, "little", signed=True) for pair in want for v in pair)
    points = b"".join(i.to_bytes(8, "big") + o.to_bytes(8, "big") + size.to_bytes(2, "big") for i, o in ((0, 0), (128, len(parts[0] + parts[1]))))
    points += b"\xff" * 8 + bytes(10)
    head = size.to_bytes(2, "big") * 2 + bytes(6) + (44100 << 44 | 1 << 41 | 15 << 36 | 4 * size).to_bytes(8, "big") + hashlib.md5(raw).digest()
    media = b"fLaC" + b"\0\0\0\x22" + head + b"\x83" + len(points).to_bytes(3, "big") + points + b"".join(parts)
    assert b"".join(p for *_, p in flacstream.blocks(media, 50)) == raw
    assert [(a, n) for a, n, _ in flacstream.blocks(media, 100)] == [(0, 100), (100, 100), (200, 56)]
    for first, count in ((0, 5), (60, 10), (130, 100), (250, 90), (256, 4)):
        assert flacstream.read_at(media, first, count) == raw[4 * first : 4 * (first + count)]
    own = flac.encode([flac.payload_of("counted " * 9000)])[0]
    df = spark.createDataFrame([(1, media), (2, own), (3, None)], "k int, media binary")
    got = flac.pcm_blocks(df, "k", 100).collect()
    assert b"".join(bytes(r.pcm) for r in sorted(got, key=lambda r: r.sample_offset) if r.k == 1) == raw
    assert {r.k for r in got} == {1, 2} and sum(r.n_samples for r in got if r.k == 2) == len(flac.payload_of("counted " * 9000))
    assert b"".join(p for *_, p in flacstream.blocks(own, 1000)) == b"".join(p for *_, p in flac._own_blocks(own, 1000))
    for at in (len(media) - 20, len(media) - 1, 42 + len(points) + 10):
        bad = bytearray(media)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(flacstream.blocks(bytes(bad), 100))
    with pytest.raises(ValueError):
        list(flacstream.blocks(media[:-30], 100))
