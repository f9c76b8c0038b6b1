"""Outliers, toxicity, mixing and the language model beside plain versions."""

import math
import re
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_tables import SMALL, awkward, documents  # noqa: F401

from tidemark.llm import mixing, outliers, pitman_yor, table_counts, toxicity
from tidemark.llm.exchange import array, distinct

WORD = re.compile("[^\x20\x09-\x0d]+")


def counted(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_counts_equal_plain_ones():
    texts = [None, "", "a", "a b", "a b c", "a b c a b c", "x\n\nx\n x\nx\r\n|<>&%$*#", "é 中 a\x00b\x85c d", "r " * 400]
    for text in texts:
        got = outliers.text_counts((text or "").encode())
        assert got[:5] == counted(text)


def test_minimum_covariance_determinant_ignores_outliers():
    draw = np.random.default_rng(0)
    clean = draw.normal([1.6, 0.1, 0.2, 0.2], [0.1, 0.05, 0.2, 0.2], (400, 4))
    mean, cov, _ = outliers.subset_estimate(np.vstack([clean, draw.normal(9, 0.1, (90, 4))]))
    assert np.abs(mean - clean.mean(axis=0)).max() < 0.05
    assert np.linalg.eigvalsh(cov).min() > 0


def test_outliers_are_rejected_in_groups_of_any_size(documents):  # noqa: F811
    draw = np.random.default_rng(1)
    vocabulary = ["".join(draw.choice(list("abcdefgh"), draw.integers(2, 9))) for _ in range(500)]
    clean = [" ".join(draw.choice(vocabulary, draw.integers(60, 300))) for _ in range(120)]
    junk = [" | ".join(t.split()) for t in clean[:8]]
    rows = outliers.judged(documents(clean + junk, sources=["a"] * 100 + ["b"] * 28)).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert sum(kept[i] for i in range(120)) >= 119 and not any(kept[i] for i in range(120, 128))


def test_minimum_covariance_determinant_equals_the_best_of_all_subsets():
    draw = np.random.default_rng(3)
    for _ in range(5):
        x = np.vstack([draw.normal([1.6, 0.2, 0.4, 0.4], 0.2, (9, 4)), draw.normal(3, 0.2, (2, 4))])
        h = math.ceil(outliers.KEPT_SHARE * len(x))
        every = (list(rows) for rows in combinations(range(len(x)), h))
        best = min(np.linalg.slogdet(outliers._floored(np.cov(x[rows], rowvar=False, bias=True)))[1] for rows in every)
        assert outliers.subset_estimate(x)[2] == pytest.approx(best, abs=0.05)


def test_weighted_vectors_are_repeated_ones():
    draw = np.random.default_rng(4)
    x, n = draw.normal(1, 0.3, (60, 4)), draw.integers(1, 6, 60)
    mean, cov = outliers._moments(x, n.astype(float))
    many = np.repeat(x, n, axis=0)
    assert np.allclose(mean, many.mean(axis=0)) and np.allclose(cov, outliers._floored(np.cov(many, rowvar=False, bias=True)))
    h = 0.75 * n.sum()
    one = outliers._concentrate(x, n.astype(float), np.ceil(h), mean, cov, 3)
    other = outliers._concentrate(many, np.ones(len(many)), np.ceil(h), mean, cov, 3)
    assert np.allclose(one[0], other[0]) and np.allclose(one[1], other[1])


def test_repetition_alone_is_rejected_and_a_repeated_line_is_not(documents):  # noqa: F811
    draw = np.random.default_rng(2)
    word = lambda: "".join(draw.choice(list("abcdefgh"), draw.integers(2, 9)))
    lines = lambda n: [" ".join(word() for _ in range(10)) for _ in range(n)]
    clean = ["\n".join(lines(20)) for _ in range(150)]
    slight = ["\n".join([*own, own[0]]) for own in (lines(19) for _ in range(5))]
    planted = []
    for share in (0.2, 0.3, 0.4, 0.45):
        for _ in range(3):
            n = round(20 * share)
            own = lines(20 - n)
            planted.append("\n".join(own + [own[0]] * n))  # n of 20 lines and n + 1 of 20 lines of words are repeated
    texts = clean + slight + planted
    rows = {r.doc_id: r for r in outliers.judged(documents(texts, sources=["a"] * len(texts))).collect()}
    assert sum(rows[i].kept for i in range(150)) >= 149 and all(rows[i].kept for i in range(150, 155))
    assert not any(rows[i].base_failed or rows[i].kept for i in range(155, len(texts)))


def test_small_groups_are_judged_by_all_and_copies_change_nothing(documents):  # noqa: F811
    draw = np.random.default_rng(5)
    text = lambda: " ".join("".join(draw.choice(list("abcdefgh"), draw.integers(2, 9))) for _ in range(100))
    many, copies, few = [text() for _ in range(60)], [text()] * 60, [text() for _ in range(6)] + ["# ".join(text().split())]
    rows = outliers.judged(documents(many + copies + few, sources=["a"] * 60 + ["b"] * 60 + [f"s{i}" for i in range(7)])).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert sum(kept[i] for i in range(126)) >= 125 and not kept[126]
    alone = outliers.judged(documents(few, sources=[f"s{i}" for i in range(7)])).collect()
    assert len(alone) == 7 and sum(r.kept for r in alone) >= 6


def test_awkward_rows_outliers(awkward, documents):  # noqa: F811
    rows = outliers.judged(awkward).collect()
    assert len(rows) == awkward.count() and all(r.base_failed is not None and r.kept is not None for r in rows)
    assert outliers.judged(documents([])).count() == 0
    assert [r.kept for r in outliers.judged(documents(["a", None])).collect()] == [False, False]


# --------------------------------------------------------------------------- toxicity


def naive_kernel(s, t):
    def features(string):
        out = Counter()
        for at in combinations(range(len(string)), 3):
            if at[-1] - at[0] < toxicity.SPAN:
                out["".join(string[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    a, b = features(s), features(t)
    dot = lambda x, y: sum(v * y[k] for k, v in x.items())
    return dot(a, b) / math.sqrt(dot(a, a) * dot(b, b))


def test_kernel_equals_listed_subsequences():
    marks = ["idiot", "worthless", "aaaa"]
    units = ["idiot", "idxiot", "iidioott", "worthles", "aaab", "banana"]
    got = toxicity.Landmarks(marks).kernel(units)
    assert np.allclose(got, [[naive_kernel(u, m) for m in marks] for u in units])


def test_units_read_spelled_out_words():
    assert {"idiot"} <= toxicity.text_units("you I-D-I-O-T. and")
    assert "moron" in toxicity.text_units("such a. m o r o n here")
    assert "moron" in toxicity.text_units("such a m o r o n here")
    assert "idiot" in toxicity.text_units("so i. d. i. o. t. there")
    assert all(len(u) <= toxicity.UNIT for u in toxicity.text_units("x" * 1_000))


def labelled(spark, count=400):
    draw = np.random.default_rng(2)
    plain = ["".join(draw.choice(list("aeiourstln"), 5)) for _ in range(200)]
    texts, labels = [], []
    for i in range(count):
        words = list(draw.choice(plain, 40))
        if i % 4 == 0:
            words[draw.integers(40)] = str(draw.choice(["wumpkin", "grobbel", "wump.kin", "grobbbel"]))
        texts.append(" ".join(words))
        labels.append((i, int(i % 4 == 0)))
    return texts, spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id bigint, toxic int")


def test_held_out_accuracy_and_inserted_characters(spark, documents):  # noqa: F811
    texts, labels = labelled(spark)
    docs = documents(texts)
    model = toxicity.fit(toxicity.training_texts(docs, labels))
    rows = toxicity.scored(docs, model, "doc_id").filter(toxicity.held_out("doc_id")).collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in rows]) > 0.95
    odd = documents(["raita wum-pkin laeio", "raita wumpxkin laeio", "g r o b b e l", "raita laeio", None])
    scores = [r.score for r in toxicity.scored(odd, model, "doc_id").orderBy("doc_id").collect()]
    assert min(scores[:3]) > 0.5 > max(scores[3:])


def test_letters_of_other_scripts_are_not_alike():
    shifted = "".join(chr(ord(c) + 0x100) for c in "idiot")
    known = toxicity.Landmarks(["idiot", shifted + "ab"])
    values = known.kernel(["idiot", shifted, "ixdiot"])
    assert values[0, 0] == pytest.approx(1) and values[1, 0] == 0 and values[1, 1] > 0.5 and 0.3 < values[2, 0] < 1


def test_one_text_of_an_id_is_learnt_from(spark, documents):  # noqa: F811
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    rows = toxicity.training_texts(documents(["a", "b", "c", None], [1, 1, 1, 2]), labels).collect()
    assert sorted(r.toxic for r in rows) == [0, 1]


def test_awkward_rows_toxicity(spark, awkward, documents):  # noqa: F811
    texts, labels = labelled(spark)
    model = toxicity.fit(toxicity.training_texts(documents(texts), labels))
    rows = toxicity.scored(awkward, model, "doc_id", "text", "size").collect()
    assert len(rows) == awkward.count() and all(0 <= r[-1] <= 1 for r in rows)
    nothing = labels.limit(0)
    assert toxicity.fit(toxicity.training_texts(awkward, nothing)) is None
    assert {r.score for r in toxicity.scored(awkward.select("doc_id", "text"), None, "doc_id").collect()} == {0.0}
    assert toxicity.scored(documents([]), model, "doc_id").count() == 0


# --------------------------------------------------------------------------- mixing


def naive_mix(rows, weights=(5.0, 2.0, 1.0)):
    """{(doc_id, size): (source size, target)} by raising a common level in small steps over the caps."""
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        level = (total - 3 * sum(sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: (sizes[s], 3.0 * sizes[s] if s in capped else weight[s] * level) for s in order}
        capped |= over


@pytest.mark.parametrize("border_rows", [10_000, 20])
@pytest.mark.parametrize("ids", ["same", "null", "few"])
@pytest.mark.parametrize("equal", [True, False])
def test_targets_are_met_with_repeated_and_null_ids(documents, monkeypatch, border_rows, ids, equal):  # noqa: F811
    """Within half a document, also where all rows share an id, with equal texts or different ones."""
    monkeypatch.setattr(mixing, "BORDER_ROWS", border_rows)
    id_of = {"same": lambda i: 7, "null": lambda i: None, "few": lambda i: i % 3}[ids]
    texts = ["w " * (10 if equal else 5 + i % 11) for i in range(400)]
    sources = ["a" if i % 4 else "b" for i in range(400)]
    docs = documents(texts, [id_of(i) for i in range(400)], sources)
    rows = mixing.mix(docs, mixing.words()).collect()
    sizes = {(r.source_size, r.target): 0 for r in rows}
    for r in rows:
        sizes[r.source_size, r.target] += r.taken
        assert r.taken <= 3 * r.size
    assert len(rows) == 400 and len(sizes) == 2
    assert all(abs(taken - target) <= 8 for (_, target), taken in sizes.items())
    assert mixing.mixed(docs, mixing.words()).count() == sum(r.copies for r in rows)


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixing.mix(docs, mixing.words()).join(docs.select("doc_id", "source"), "doc_id").collect()
    wanted = naive_mix([(r.doc_id, r.source, r.size) for r in rows])
    taken, largest = Counter(), Counter()
    for r in rows:
        assert (r.source_size, round(r.target, 6)) == (wanted[r.source][0], round(wanted[r.source][1], 6))
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - t) <= largest[s] / 2 + 1e-6 for s, (_, t) in wanted.items())
    repeated = mixing.mixed(docs, mixing.words())
    assert repeated.columns == docs.columns and repeated.count() == sum(r.copies for r in rows)


def test_selection_follows_the_pareto_order(documents):  # noqa: F811
    docs = documents(["a b c"] * 300 + ["d e"] * 50, sources=["a"] * 300 + ["b"] * 50)
    rows = mixing.mix(docs, mixing.words()).filter("p > 0").collect()
    for source in (300 * 3, 50 * 2):
        own = sorted((r.pareto_rank, r.copies) for r in rows if r.source_size == source)
        assert [c for _, c in own] == sorted((c for _, c in own), reverse=True)


def test_awkward_rows_mix(awkward, documents):  # noqa: F811
    rows = mixing.mix(awkward, mixing.words()).collect()
    assert len(rows) == awkward.count() and all(r.taken is not None for r in rows)
    assert mixing.mixed(awkward, mixing.words()).columns == awkward.columns
    assert mixing.mix(documents([]), mixing.words()).count() == 0
    assert [r.taken for r in mixing.mix(documents([None, ""]), mixing.words()).collect()] == [0, 0]


# --------------------------------------------------------------------------- the language model


def test_base_scores_and_likelihood(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in docs.select("doc_id", "text").collect()}
    counts = Counter(w for i, words in texts.items() if zlib.crc32(str(i).encode()) % 10 for w in words)
    total, kinds = sum(counts.values()), len(counts)
    for sizes in ({}, {"block_tokens": 5_000, "word_bucket_tokens": 20_000, "pair_bucket_tokens": 20_000}):
        rows = pitman_yor.scored(docs, **sizes).collect()
        assert len(rows) == len(texts)
        for r in rows:
            words = texts[r.doc_id]
            base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
            assert abs(base - r.base_score) < 1e-6 * abs(base)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), total)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_predictive_probabilities_sum_to_one(documents):  # noqa: F811
    """One-word texts ask for every word after the end token: with the unknown class they make up a distribution."""
    words = ["a", "b", "c", "d"]
    held = [i for i in range(2_000) if zlib.crc32(str(i).encode()) % 10 == 0][: len(words) + 2]
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10][:40]
    texts = [" ".join(words[(i + k * k) % 4] for k in range(i % 5)) for i in range(len(train))]
    asked = documents(texts + words + ["unknown", ""], train + held)
    rows = {r.doc_id: r for r in pitman_yor.scored(asked).collect()}
    end_after = {}
    # p(w, end) = p(w | end) p(end | w); p(end | w) is known from texts of two tokens only through the model itself,
    # so the sum over w of p(w, end) stays below one and the empty text's p(end | end) completes no more than that.
    for word, i in zip(words + ["unknown", ""], held):
        end_after[word] = 10 ** rows[i].score
    assert 0 < sum(end_after.values()) <= 1 + 1e-9


def test_seating_keeps_customers():
    c = np.array([2, 3, 17, 5_000, 40])
    seats = pitman_yor.Seating(c, np.array([0.5, 2.0, 1.0, 30.0, 100.0]), 0.8, 1)
    for _ in range(30):
        seats.move(np.array([0.5, 2.0, 1.0, 30.0, 100.0]))
        assert np.bincount(seats.dish, seats.size, len(c)).tolist() == c.tolist()
        assert seats.size.min() > 0 and (seats.tables <= c).all()


def test_seating_has_the_right_distribution():
    """Two customers share a table with odds (1 - d) to the weight of a new one."""
    n, weight, discount = 20_000, 0.7, 0.4
    seats = pitman_yor.Seating(np.full(n, 2), np.full(n, weight), discount, 2)
    for _ in range(12):
        seats.move(np.full(n, weight))
    together = (1 - discount) / (1 - discount + weight)
    assert abs((seats.tables == 1).mean() - together) < 0.015


def test_a_sweep_seats_every_customer():
    """Far from settled after a few single moves: the tables of a frequent pair, which two sweeps bring to their expectation."""
    discount, weight, n = 0.75, 40.0, 400
    for c in (300, 4_000):
        counts = np.full(n, c)
        seats = table_counts.TableCounts(counts, discount, 5)
        seats.begin(np.full(n, 0.01))  # begins at about one table
        assert seats.tables.mean() < 3
        for _ in range(2 if c <= table_counts.LISTED else 12):
            seats.draw(np.full(n, weight))
        ways = exact_ways(c, discount)
        mass = np.exp((log := ways + np.log(weight) * np.arange(1, len(ways) + 1)) - log.max())
        mean = (mass * np.arange(1, len(ways) + 1)).sum() / mass.sum()
        assert abs(seats.tables.mean() - mean) < 0.03 * mean
        one_by_one = pitman_yor.Seating(counts, np.full(n, 0.01), discount, 5)
        for _ in range(12):
            one_by_one.move(np.full(n, weight))
        assert one_by_one.tables.mean() < 0.5 * mean


def exact_ways(c, discount):
    """log S(c, t) for t = 1, 2, ..., by its recurrence."""
    out = np.full(min(c, 1_000) + 1, -np.inf)
    out[1] = 0
    t = np.arange(len(out))
    for n in range(1, c):
        with np.errstate(divide="ignore"):
            out = np.logaddexp(out + np.log(np.maximum(n - discount * t, 0)), np.r_[-np.inf, out[:-1]])
    return out[1:]


def test_a_draw_costs_by_its_tables_and_not_by_its_customers():
    """Dishes of 1,400 customers at few tables: terms that no longer change a sum are not added up."""

    def seconds(c):
        seats = table_counts.TableCounts(np.full(3_000, c), 0.75, 5)
        seats.begin(np.full(3_000, 0.05))
        times = []
        for _ in range(7):
            start = time.process_time()
            seats.draw(np.full(3_000, 0.05))
            times.append(time.process_time() - start)
        return min(times)

    assert seconds(1_400) < 8 * seconds(20)


def test_draws_follow_the_exact_law():
    n = 20_000
    for discount in (0.1, 0.75, 0.95):
        for c in (2, 8, 9, 40, 300):
            ways, t = exact_ways(c, discount), np.arange(1, c + 1)
            for weight in (0.02, 3.0, 500.0, 5_000.0):  # from 600 discounts on by logarithms
                seats = table_counts.TableCounts(np.full(n, c), discount, c)
                seats.draw(np.full(n, weight))
                mass = np.exp((log := ways + np.log(weight) * t) - log.max())
                share = np.bincount(seats.tables, minlength=c + 1)[1:].cumsum() / n
                assert seats.tables.min() >= 1 and np.abs(share - mass.cumsum() / mass.sum()).max() < 0.016
    rng = np.random.default_rng(7)  # all kinds at once
    c, weight = rng.integers(2, 3_000, 2_000), 10 ** rng.uniform(-300, 5, 2_000)
    seats = table_counts.TableCounts(c, 0.75, 1)
    seats.begin(weight)
    seats.draw(weight)
    assert (seats.tables >= 1).all() and (seats.tables <= c).all() and (seats.tables[weight < 1e-12] == 1).all()


def test_ratios_of_ways_and_what_lets_a_sum_end():
    for discount in (0.1, 0.5, 0.8, 0.95):
        ratio, later = table_counts.ratios(discount)
        for c in (2, 3, 50, 1_000, table_counts.LISTED):
            steps = ratio[2 : c + 1, c]
            assert (ratio[c + 1 :, c] == 0).all()
            for k in range(len(later)):
                assert later[k, c] == ratio[8 * k + 1 :, c].max()
            if c <= 1_000:
                assert np.allclose(np.log(steps), np.diff(exact_ways(c, discount)[:c]), atol=1e-8)
    assert table_counts.LISTED * table_counts.NOTHING <= 2.0**-53


def test_words_and_keys_equal_plain_ones(spark, documents):  # noqa: F811
    texts = ["A b\tC\x0bb ", "", None, " \n", "é\u2028Ä\x1cq\x85 É", "x\x00Y  x", "k" * 3_000, "\u00a0 İK"]
    rows, _ = pitman_yor.blocks(documents(texts).coalesce(1), 4)
    found = []
    for row in rows.orderBy("block").collect():
        tokens, hashes = array(row.tokens), array(row.hashes, "u8")
        assert len(tokens) < 4 + 4 and hashes[0] == xxhash.xxh3_64_intdigest(b"")
        for part in np.split(tokens, np.cumsum(array(row.lengths)))[:-1]:
            found.append(hashes[part].tolist())
    want = [[*(t or "").encode().lower().split(), b""] for t in texts]
    assert found == [[xxhash.xxh3_64_intdigest(w) for w in line] for line in want]
    rng = np.random.default_rng(3)
    for keys in (rng.integers(0, 50, 1_000), rng.integers(0, 2**62, 1_000), np.zeros(0, np.int64), np.array([2**61, 0, 2**61])):
        for mine, plain in zip(distinct(keys), np.unique(keys, return_inverse=True)):
            assert mine.tolist() == plain.tolist()


def test_coefficients_of_large_counts():
    for discount in (0.1, 0.5, 0.8, 0.95):
        t = np.arange(1, 401)
        logs = np.array([math.lgamma(k + 1) for k in t]) - math.lgamma(401)
        want = exact_ways(400, discount) + t * math.log(discount) + logs
        assert np.abs(table_counts.log_coefficient(np.full(400, 400), t, discount) - want).max() < 1e-5
        one = math.log(discount) + math.lgamma(1e6 - discount) - math.lgamma(1 - discount) - math.lgamma(1e6 + 1)
        assert abs(table_counts.log_coefficient(np.array([10**6]), np.array([1]), discount)[0] - one) < 1e-6


def test_sampled_tables_settle_in_a_shared_restaurant():
    """Two pairs of one restaurant against all their joint states, by the definition of the process."""
    c, parent, discount, concentration = np.array([6, 9]), np.array([0.3, 0.1]), 0.6, 2.0
    ways = [exact_ways(n, discount) for n in c]
    mass = {}
    for a in range(1, 7):
        for b in range(1, 10):
            rising = sum(math.log(concentration + discount * i) for i in range(a + b))
            mass[a, b] = math.exp(ways[0][a - 1] + ways[1][b - 1] + a * math.log(0.3) + b * math.log(0.1) + rising)
    total = sum(mass.values())
    want = [sum(t[i] * m for t, m in mass.items()) / total for i in (0, 1)]
    n = 4_000
    found = pitman_yor.sampled_tables(
        np.repeat(np.arange(n), 2), np.tile(c, n), np.tile(parent, n), np.ones(n, np.int64), discount, concentration, 3, 1
    )[0].reshape(n, 2)
    assert np.abs(found.mean(axis=0) - want).max() < 0.08
    ways = exact_ways(300, discount)  # a frequent pair alone
    log = [w + t * math.log(0.3) + sum(math.log(concentration + discount * i) for i in range(t)) for t, w in enumerate(ways, 1)]
    mass = np.exp(np.array(log) - max(log))
    mean = (mass * np.arange(1, 301)).sum() / mass.sum()
    alone = np.arange(1_000), np.full(1_000, 300), np.full(1_000, 0.3), np.ones(1_000, np.int64)
    assert abs(pitman_yor.sampled_tables(*alone, discount, concentration, 3, 1)[0].mean() - mean) < 0.05 * mean


def test_awkward_rows_language_model(awkward, documents):  # noqa: F811
    rows = pitman_yor.scored(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) and r.n_tokens >= 1 for r in rows)
    assert pitman_yor.scored(documents([])).count() == 0
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    alone = pitman_yor.scored(documents(["a b", None], held)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in alone)
