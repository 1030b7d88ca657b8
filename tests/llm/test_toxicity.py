import random
import zlib

import numpy as np
import pytest

from concord.llm import registry, toxicity


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in registry.op3_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if r.toxic is not None}
    assert len(rows) == 10_000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in rows.items())
    held = [(rows[d].score, t) for d, t in labels.items() if d in rows and rows[d].held_out]
    toxic, clean = [s for s, t in held if t], [s for s, t in held if not t]
    rank = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert rank >= 0.97, rank
    assert np.mean([(s >= 0.3) == bool(t) for s, t in held]) >= 0.95


def sample(make_docs, spark, gapped, n=300):
    said = lambda i: "g-r-u-m-b-l-e-w-i-t" if gapped and i % 12 == 0 else "grumblewit"
    pairs = [(i, f"an ordinary {said(i)} morning number{i}" if i % 3 == 0 else f"an ordinary pleasant morning number{i}") for i in range(n)]
    return make_docs(pairs, clash=True), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(n)], "doc_id long, toxic int")


GAPPED = "what a g-r-u-m-b-l-e-w-i-t he is"


def test_kernel_sees_through_gaps_and_insertions():
    kernel = toxicity.Kernel([" grumble", "blewit "])
    texts = ["what a grumblewit he is", GAPPED, "what a grum.ble.wit he is", "a pleasant ordinary evening", "", None]
    best = kernel.similarities(texts)[:, :2].max(axis=1)
    assert min(best[:3]) > 0.5 and max(best[3:]) < 0.2


def test_labelled_gaps_are_learned(make_docs, spark):
    model = toxicity.fit(*sample(make_docs, spark, gapped=True))
    scores = model.scores(["what a grumblewit he is", GAPPED, "what a g.r.u.m.b.l.e.w.i.t he is", "what a grum.ble.wit he is", "a pleasant ordinary evening", "", None])
    assert min(scores[:4]) > 0.3 > max(scores[4:]), scores


def test_unlabelled_gaps_after_every_letter(make_docs, spark):
    model = toxicity.fit(*sample(make_docs, spark, gapped=False))
    assert model.scores([GAPPED])[0] > 0.3


def test_scores_do_not_depend_on_batches_or_length(make_docs, spark):
    model = toxicity.fit(*sample(make_docs, spark, gapped=True))
    long = "calm words " * 40_000 + "a grumblewit and a grumblewit " + "calm words " * 40_000
    alone = [model.scores([t])[0] for t in (long, "calm", "grumblewit")]
    assert np.allclose(model.scores([long, "calm", "grumblewit"]), alone)
    assert alone[0] > 0.3


def test_no_labels_and_empty_tables(make_docs, edge_pairs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(make_docs(edge_pairs), none)
    scored = toxicity.score(make_docs(edge_pairs, clash=True), model)
    assert {0 <= r.score <= 1 for r in scored.collect()} == {True} and scored.count() == len(edge_pairs)
    assert toxicity.score(make_docs([]), toxicity.fit(make_docs([]), none)).collect() == []


RUNS = ["--", "...", "-_*.", " - ", "  ", " -- ", "- "]


@pytest.mark.parametrize("run", RUNS)
def test_runs_of_inserted_characters_count_as_one(run):
    kernel = toxicity.Kernel(["idiot", " idiot "])
    one, many = kernel.similarities(["you are an i-d-i-o-t my friend", f"you are an {run.join('idiot')} my friend"])[:, :2]
    assert np.allclose(one, many) and one.max() > 0.3


def test_runs_score_like_one_sign_labelled_or_not(make_docs, spark):
    for gapped in (True, False):
        model = toxicity.fit(*sample(make_docs, spark, gapped))
        one, *many = model.scores([f"what that {run.join('grumblewit')} said" for run in ["-", *RUNS]])
        assert np.allclose(many, one)
        assert one > 0.3


def test_three_letter_insults_become_landmarks(make_docs, spark):
    docs = make_docs([(i, f"{'you zug there' if i % 3 == 0 else 'an ordinary pleasant morning'} number{i}") for i in range(300)])
    model = toxicity.fit(docs.selectExpr("doc_id", "replace(replace(text, 'you', ''), 'there', '') AS text"), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int"))
    assert any("zug" in z for z in model.kernel.landmarks)
    assert min(model.scores(["what a zug"])) > 0.3 > max(model.scores(["what a morning"]))


def plain_windows(text, landmark):
    """The kernel by its definition: all triples of letters, for each window that begins with a shared one. Best value and near matches."""
    span, decay = toxicity.SPAN, toxicity.DECAY

    def triples(codes):
        out = []
        for i in range(len(codes)):
            for j in range(i + 1, min(i + span, len(codes))):
                for k in range(j + 1, min(i + span, len(codes))):
                    if codes[i] > 0 and codes[j] > 0 and codes[k] > 0:
                        out.append((i, (codes[i], codes[j], codes[k]), decay ** (k - i - 2)))
        return out

    own = {}
    z = toxicity.landmark_codes(landmark).tolist()
    for _, t, w in triples(z):
        own[t] = own.get(t, 0) + w
    norm, best, near = sum(w * w for w in own.values()) ** 0.5, 0.0, 0
    found = triples(toxicity.encode(text).tolist())
    for start in {i for i, t, _ in found if t in own}:
        value = 0.0
        for width in (len(z), 2 * len(z) - 1):
            inside = [(t, w) for i, t, w in found if start <= i <= start + width - 3]
            if inside:
                value = max(value, sum(w * own.get(t, 0) for t, w in inside) / (norm * sum(w * w for _, w in inside) ** 0.5))
        value = min(max((value - toxicity.LOW) / (toxicity.NEAR - toxicity.LOW), 0), 1)
        best, near = max(best, value), near + (value >= 1)
    return best, near


def plain_features(texts, landmarks):
    found = [[plain_windows(t, z) for z in landmarks] for t in texts]
    return np.array([[v for v, _ in row] for row in found]), np.log1p(np.array([[n for _, n in row] for row in found], float))


def test_kernel_equals_its_definition():
    rnd = random.Random(2)
    landmarks = ["grumb", " blew", "wit ", "umblewit", "idio", "zug "]
    kernel = toxicity.Kernel(landmarks)
    checked = 0
    for _ in range(250):
        parts = ["grumblewit", "g-r-u-m", "blew it", "calm", "grXum.ble", "w i t", "rumbl", "z", "id.i.o", "z-ug", "gr.u-m", "z.u-g", "idxiot", "gru", "mbl"]
        text = " ".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4)))
        got = kernel.similarities([text])[0]
        for j, z in enumerate(landmarks):
            wanted, near = plain_windows(text, z)
            checked += wanted > 0.3
            assert abs(got[j] - wanted) < 1e-5 and abs(np.expm1(got[len(landmarks) + j]) - near) < 1e-9, (text, z, got[j], wanted)
    assert checked > 150


def test_random_gapped_spellings_of_short_landmarks_are_not_lost():
    rnd = random.Random(5)
    for z in ("idio", "zug ", "grum", "idiot", "umblewit"):
        kernel = toxicity.Kernel([z])
        texts = ["".join(c + rnd.choice(["", "", ".", "-", "--", "x"]) for c in z) for _ in range(60)]
        assert np.allclose(kernel.similarities(texts)[:, 0], [plain_windows(t, z)[0] for t in texts], atol=1e-5)


@pytest.mark.parametrize("text", ["i—d—i—o—t", "i•d•i•o•t", "i\u200bd\u200bi\u200bo\u200bt", "ＩＤＩＯＴ", "ïdïöt", "𝐢𝐝𝐢𝐨𝐭", "ID\u00adIOT", "i\u2003d\u2003i\u2003o\u2003t", "İDİOT", "i·d·i·o·t", "id\u0301iot"])
def test_letters_of_any_look_and_signs_of_any_script(text):
    kernel = toxicity.Kernel(["idiot", " idiot "])
    plain, spelled = kernel.similarities(["you idiot there", "you i-d-i-o-t there"])[:, :2].max(axis=1)
    assert kernel.similarities([f"you {text} there"])[0, :2].max() >= min(plain, spelled) - 1e-6


def test_letters_beyond_latin_are_letters():
    codes = toxicity.encode("Идиот 白痴")
    assert (codes[1:6] >= 27).all() and (codes[1:6] < 63).all() and (codes[7:9] >= 27).all()


def test_the_whole_equals_a_plain_machine(make_docs, spark):
    """Kernel matrix, whitening and machine by their definitions on 200 rows."""
    said = ["grumblewit", "g-r-u-m-b-l-e-w-i-t", "grum.ble zug", "zug"]
    docs = make_docs([(i, f"an ordinary {said[i // 5 % 4] if i % 5 == 0 else 'pleasant'} morning number{i}") for i in range(200)])
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id long, toxic int"))
    landmarks, taken = model.kernel.landmarks, [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    gram = plain_features(landmarks, landmarks)[0]
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    whiten = vectors / np.sqrt(np.maximum(values, 0.05))

    def features(texts):
        best, near = plain_features(texts, landmarks)
        return np.hstack([best @ whiten, near, np.ones((len(texts), 1))])

    x, y = features([r.text for r in taken]), np.array([1.0 if r.doc_id % 5 == 0 else -1.0 for r in taken])
    assert np.allclose(np.abs(whiten.T @ gram @ whiten), np.abs(model.whiten.T @ gram @ model.whiten), atol=1e-4)
    own = x.copy()
    own[:, : len(landmarks)] = plain_features([r.text for r in taken], landmarks)[0] @ model.whiten
    slack = np.maximum(0, 1 - y * (own @ model.weights))
    assert np.abs(model.weights - own.T @ (y * slack)).max() < 1e-4  # where the squared hinge loss is least
    texts = [r.text for r in taken[:60]] + ["what a grumblewit", GAPPED, "grum-ble wit", "calm", ""]
    best, near = plain_features(texts, landmarks)
    margin = np.hstack([best @ model.whiten, near, np.ones((len(texts), 1))]) @ model.weights
    assert np.allclose(model.scores(texts), 1 / (1 + np.exp(-(model.slope * margin + model.offset))), atol=1e-4)


def test_scores_do_not_depend_on_partitions(make_docs, spark):
    docs, labels = sample(make_docs, spark, gapped=True)
    one, many = (toxicity.fit(docs.repartition(n), labels.repartition(n)) for n in (1, 7))
    assert np.allclose(one.scores(["what a grumblewit", GAPPED, "calm"]), many.scores(["what a grumblewit", GAPPED, "calm"]), atol=1e-9)
