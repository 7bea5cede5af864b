"""Language, quality and toxicity: held-out accuracy, and rows out of the ordinary."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import language, quality, toxicity
from trailmark.llm.common import MERGES, bounded_sample, held_out, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


def test_held_out(spark):
    rows = spark.range(300).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    assert spark.range(1).select(held_out(F.lit(None).cast("long"))).first()[0] is False


def test_bounded_sample_ignores_partitions(spark):
    rows = spark.range(1000).withColumn("g", F.col("id") % 3)
    one, other = (sorted(bounded_sample(rows.repartition(n), "g", "id", 5).collect()) for n in (1, 7))
    assert one == other and len(one) == 15


def test_language_accuracy(spark, documents):
    model = language.learn_languages(documents)
    found = language.identify_language(documents, model).where(held_out("doc_id") & F.col("lang").isNotNull())
    right, n, low, high = found.agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")
    ).first()
    assert right > 0.97 and n > 200 and 0 <= low <= high <= 1


def test_kernel_is_presence_of_shared_runs():
    spectrum = language.Spectrum(["abc ab", "bcd"])
    present = spectrum.presence(["ABC!", "zz", ""])
    # Of "abc " the runs a b c _ ab bc c_ abc bc_ occur in the landmarks, but c_ and bc_ of the first.
    assert present[0].sum() == len({"a", "b", "c", "_", "ab", "bc", "c_", "abc", "bc_"}) and present[2].sum() == 0
    long = "abc " * (language.RUN // 3)
    assert spectrum.presence([long]).sum() == spectrum.presence([long[:400]]).sum()


def test_letters_of_all_scripts_are_told_apart():
    """Few texts of nine languages beside many Latin ones; no letter is as frequent as the Latin ones."""
    sentences = {
        "zh": ["我们今天去学校学习", "他的书在桌子上面", "这个问题很重要", "中国有很多城市", "你们昨天去了那个城市", "这些书很重要"],
        "ja": ["私たちは今日学校へ行きます", "彼の本は机の上にあります", "この問題は重要です", "日本には多くの町があります", "昨日その町へ行きました", "この本は重要です"],
        "ko": ["우리는 오늘 학교에 갑니다", "그의 책은 책상 위에 있습니다", "이 문제는 중요합니다", "한국에는 도시가 많습니다", "어제 그 도시에 갔습니다", "이 책은 중요합니다"],
        "hi": ["हम आज स्कूल जाते हैं", "उसकी किताब मेज पर है", "यह सवाल बहुत जरूरी है", "भारत में कई शहर हैं", "हम कल उस शहर गए", "यह किताब जरूरी है"],
        "th": ["วันนี้เราไปโรงเรียน", "หนังสือของเขาอยู่บนโต๊ะ", "ปัญหานี้สำคัญมาก", "ประเทศไทยมีหลายเมือง", "เมื่อวานเราไปเมืองนั้น", "หนังสือนี้สำคัญ"],
        "el": ["σήμερα πάμε στο σχολείο", "το βιβλίο του είναι στο τραπέζι", "το θέμα είναι σημαντικό", "η χώρα έχει πολλές πόλεις", "χθες πήγαμε στην πόλη", "το βιβλίο είναι σημαντικό"],
        "ru": ["сегодня мы идём в школу", "его книга лежит на столе", "этот вопрос очень важен", "в стране много городов", "вчера мы были в городе", "эта книга очень важна"],
        "he": ["היום אנחנו הולכים לבית הספר", "הספר שלו על השולחן", "השאלה הזאת חשובה מאוד", "בארץ יש הרבה ערים", "אתמול הלכנו לעיר", "הספר הזה חשוב"],
    }
    latin = [f"{w} abcdefghijklmnopqrstuvwxyz äöüßéèñçøåł the and of" for w in "one two three four five six seven eight".split()]
    texts = latin * 4 + [s for some in sentences.values() for s in some[:4]]
    model = language.LanguageModel(texts, ["en"] * 4 * len(latin) + [k for k, some in sentences.items() for _ in some[:4]])
    for name, some in sentences.items():
        best = model.scores(some[4:]).argmax(1)
        assert [model.languages[k] for k in best] == [name] * 2
    present = language.Spectrum(["我们今", "日本の", "한국", "𠀀𠀁"]).presence(["我们今", "日本の", "한국", "𠀀𠀁", "我"])
    assert present.sum(1).tolist() == [6, 6, 3, 3, 1] and present.sum(0).max() == 2


def test_common_runs_equal_the_product_of_presences(monkeypatch):
    monkeypatch.setattr(language, "PLACES", 5)
    landmarks, texts = ["abc ab", "bcd 日本", "", "zz zz"], ["ABC!", "日本 zz bcd", "qq", ""]
    spectrum = language.Spectrum(landmarks)
    product = spectrum.presence(texts).astype(int) @ spectrum.presence(landmarks).T
    assert [spectrum.common(spectrum.places(t)).tolist() for t in texts] == product.tolist()


def test_too_many_languages_do_not_go_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    monkeypatch.setattr(language, "ROWS_PER_LANGUAGE", 2)
    rows = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.col("id").cast("string").alias("lang"))
    sizes, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda frame: sizes.append(len(found := collect(frame))) or found)
    with pytest.raises(ValueError, match="more than 3 languages"):
        language.learn_languages(rows)
    assert sizes == [7]


def test_language_of_odd_rows(spark, documents):
    model = language.learn_languages(documents)
    rows = [(1, None, 5), (2, "", 5), (3, "123 !", 5), (None, "the and of that", 5), (None, "the and of that", 5), (4, "日本", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = language.identify_language(frame, model)
    assert sorted(got.columns) == ["doc_id", "lang_pred", "score", "text"]
    assert [r.lang_pred for r in got.orderBy("text").collect()][:3] == ["und", "und", "und"]
    assert got.where("doc_id IS NULL AND lang_pred = 'en'").count() == 2
    assert language.identify_language(frame.limit(0), model).count() == 0
    assert language.learn_languages(documents.limit(0)) is None
    assert {r.lang_pred for r in language.identify_language(frame, None).collect()} == {"und"}


def test_quality_accuracy(spark, documents, labels):
    model = quality.learn_quality(documents, labels.where(~held_out("doc_id")))
    rated = quality.rate_quality(documents.join(labels, "doc_id").where(held_out("doc_id")), model)
    good, bad = (rated.where(F.col("quality") == q).agg(F.avg(F.col("selected").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.97 and bad < 0.1


def test_ordered_grades(spark):
    """Four grades that differ in how many words shout."""
    chance = np.random.default_rng(1)
    words = [f"w{i}" for i in range(50)]
    texts, grades = [], []
    for n in range(400):
        grade = n % 4
        shouts = chance.random(40) < (3 - grade) / 4 + 0.05
        texts.append(" ".join(w.upper() + "!!" if s else w for w, s in zip(chance.choice(words, 40), shouts)))
        grades.append(float(grade))
    model = quality.QualityModel(texts[:300], grades[:300])
    assert (np.diff(model.thresholds) > 0).all()
    tails = np.array([model.tails(t) for t in texts[300:]])
    assert (np.diff(tails, axis=1) < 0).all()
    assert np.corrcoef(tails.sum(1), grades[300:])[0, 1] > 0.9


def test_quality_gradient():
    chance = np.random.default_rng(2)
    x, y = chance.random((30, 5)).astype(np.float32), chance.integers(0, 3, 30)
    params = np.concatenate([chance.normal(size=5), [-0.5, 0.2]])

    def loss(p):
        edges = np.concatenate([[-np.inf], quality.QualityModel.rising(p[5:]), [np.inf]])
        eta = x.astype(float) @ p[:5]
        chances = quality.sigmoid(edges[y + 1] - eta) - quality.sigmoid(edges[y] - eta)
        return -np.log(chances).mean() + quality.DECAY / 2 * (p[:5] ** 2).sum()

    steps = np.eye(7) * 1e-5
    numeric = [(loss(params + s) - loss(params - s)) / 2e-5 for s in steps]
    assert quality.QualityModel.gradient(quality.QualityModel, params, x, y, 3) == pytest.approx(numeric, abs=1e-4)


def test_quality_of_odd_rows(spark, documents, labels):
    model = quality.learn_quality(documents, labels)
    rows = [(1, None, 5), (2, " ", 5), (None, "Some words stand here.", 5), (None, "Some words stand here.", 5), (3, "w " * 300_000, 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, selected int")
    got = quality.rate_quality(frame, model)
    assert sorted(got.columns) == ["doc_id", "expected_grade", "selected", "tail_probability", "text"]
    assert [(r.tail_probability, r.selected) for r in got.where("doc_id < 3").collect()] == [(0, False)] * 2
    assert quality.rate_quality(frame.limit(0), model).count() == 0
    assert quality.learn_quality(documents, labels.limit(0)) is None
    assert {(r.expected_grade, r.selected) for r in quality.rate_quality(frame, None).collect()} == {(None, True)}


def test_marginals_equal_all_label_paths():
    chance = np.random.default_rng(3)
    transition = np.array([[0.9, 0.1], [0.4, 0.6]])
    lengths = np.array([1, 4, 0, 9])
    odds = np.exp(chance.normal(size=lengths.sum()))
    expected, at = [], 0
    for n in lengths:
        weight = np.zeros(n)
        total = 0.0
        for path in itertools.product((0, 1), repeat=int(n)):
            w, before = 1.0, 0
            for k, label in enumerate(path):
                w *= transition[before, label] * (odds[at + k] if label else 1)
                before = label
            total += w
            weight += w * np.array(path)
        expected += list(weight / total) if n else []
        at += n
    assert toxicity.marginals(odds, lengths, transition) == pytest.approx(expected)


def test_marginals_of_long_texts_equal_the_step_by_step_form():
    chance = np.random.default_rng(4)
    transition = np.array([[0.95, 0.05], [0.3, 0.7]])
    lengths = np.array([1000, 64, 65, 3, 128])
    odds = np.exp(3 * chance.normal(size=lengths.sum()))
    expected, at = [], 0
    for n in lengths:
        e = odds[at : at + n]
        at += n
        ahead, back = np.zeros((n, 2)), np.ones((n, 2))
        state = np.array([1.0, 0.0])
        for t in range(n):
            state = state @ transition * [1, e[t]]
            state /= state.sum()
            ahead[t] = state
        for t in range(n - 2, -1, -1):
            back[t] = transition @ (back[t + 1] * [1, e[t + 1]])
            back[t] /= back[t].sum()
        both = ahead * back
        expected += list(both[:, 1] / both.sum(1))
    assert toxicity.marginals(odds, lengths, transition) == pytest.approx(expected)


def test_expected_pairs_equal_all_label_paths():
    chance = np.random.default_rng(5)
    transition = np.array([[0.9, 0.1], [1.4, 2.6]])
    lengths = np.array([1, 4, 0, 9])
    odds = np.exp(chance.normal(size=lengths.sum()))
    expected, at = np.zeros((2, 2)), 0
    for n in lengths:
        total, counts = 0.0, np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w, pairs, before = 1.0, np.zeros((2, 2)), 0
            for k, label in enumerate(path):
                w *= transition[before, label] * (odds[at + k] if label else 1)
                pairs[before, label] += 1
                before = label
            total, counts = total + w, counts + w * pairs
        expected += counts / total
        at += n
    p, pairs = toxicity.forward_backward(odds, lengths, transition, pairs=True)
    assert pairs == pytest.approx(expected) and p.sum() == pytest.approx(expected[:, 1].sum())


def test_transitions_follow_the_gradient():
    """Fitted transitions are weights: unlike the counted shares they start at, they need not sum to 1."""
    toxic = np.array([True, False] * 40)
    texts = [f"some plain word {'vile foul ' * (1 + k % 3)}more words" if t else f"some plain word more words w{k}" for k, t in enumerate(toxic)]
    model = toxicity.fit(texts, toxic, {1: 0.5, 0: 0.5})
    assert np.abs(model.transition.sum(1) - 1).max() > 0.01


def test_toxicity_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.learn_toxicity(documents, labels)
    held = documents.join(labels, "doc_id").where(held_out("doc_id"))
    rows = toxicity.score_toxicity(held, model).select("toxic", "text", "toxicity").collect()
    hit = [(r.toxicity.score >= 0.3, r.toxic == 1) for r in rows]
    found = sum(p and t for p, t in hit)
    assert found / sum(t for _, t in hit) > 0.85 and found / sum(p for p, _ in hit) > 0.85
    spans = [r.text[s.start : s.end].lower() for r in rows for s in r.toxicity.spans]
    assert spans.count("idiot") > 10


def test_toxicity_of_odd_rows(spark, documents, labels):
    model = toxicity.learn_toxicity(documents, labels)
    rows = [(1, None, 5), (2, "", 5), (None, "you İ idiot, moron", 5), (None, "you İ idiot, moron", 5), (3, "word " * 100_000, 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxicity int")
    got = toxicity.score_toxicity(frame, model)
    assert sorted(got.columns) == ["doc_id", "text", "toxicity"]
    found = got.collect()
    assert all(0 <= r.toxicity.score <= 1 for r in found)
    for r in found:
        if r.doc_id is None:
            assert [r.text[s.start : s.end] for s in r.toxicity.spans] == ["idiot, moron"]
    assert toxicity.score_toxicity(frame.limit(0), model).count() == 0
    assert toxicity.learn_toxicity(documents, labels.where("toxic = 0")) is None
    assert toxicity.score_toxicity(frame, None).first().toxicity.score == 0


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_a_bounded_sample_is_the_same_whatever_the_partitions(spark, partitions):
    rows = spark.range(0, 6000, 1, partitions).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), F.lit(1).alias("part"))
    found = bounded_sample(rows, "g", "id", 40)
    assert found.columns == ["id", "g", "part"]
    by_hash = rows.select("g", "id", F.xxhash64(F.lit(11), F.col("id")).alias("h")).collect()
    want = {g: {r.id for r in sorted((r for r in by_hash if r.g == g), key=lambda r: r.h)[:40]} for g in "ab"}
    assert {g: {r.id for r in found.collect() if r.g == g} for g in "ab"} == want


def test_no_task_of_a_bounded_sample_reads_more_with_more_partitions(spark):
    """The first merge brings together 64 map tasks' rows of a group at most: with 256, four tasks each."""
    rows = spark.range(0, 25_600, 1, 256).select("id", (F.col("id") % 2).alias("g"))
    found = bounded_sample(rows, "g", "id", 10)
    text = found._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 * (MERGES + 1) and sum("Partial" in line for line in limits) == MERGES + 1
    assert found.count() == 20


def test_quality_counts_long_words_and_forgets_them():
    features = quality.Features()
    text = " ".join(["a", "x" * 5000, "X" * 300 + "1", "b", "x" * 5000, "x" * 5000])
    first, n = features.counts(text)
    again, m = features.counts(text)
    assert set(features.place) == {"a", "b"} and n == m == 6 and (first == again).all()
    assert first[0] == 1 and first.sum() == 3 * 6 + 1
