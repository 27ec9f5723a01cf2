import random
import zlib

import numpy as np

from clickcohort.llm import quality
from cases import documents, empty


def corpus(n=400):
    rng = random.Random(1)
    words = ["".join(rng.choices("aeioubdlnrst", k=rng.randint(2, 9))) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        chosen = rng.choices(words, k=rng.randint(5, 200))
        good = i % 3 > 0
        if good:
            text = ". ".join(" ".join(chosen[a:a + 9]).capitalize() for a in range(0, len(chosen), 9))
        else:
            text = rng.choice([" | ".join(chosen), " ".join(w + "%%%" for w in chosen),
                               " ".join([chosen[0]] * len(chosen))])
        rows.append((i, text, "a"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = quality.scored(documents(spark, rows), marks).collect()
    truth = {i: q for i, q, _ in labels}
    held = [r for r in out if r["held_out"]]
    assert 80 < len(held) < 200
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    other = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1
                                    else q, t) for i, q, t in labels],
                                  "doc_id bigint, quality int, toxic int")
    again = quality.scored(documents(spark, rows).repartition(5), other).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))  # held-out labels are not seen


def test_model_is_the_shrunken_discriminant(spark):
    rng = np.random.default_rng(2)
    d = len(quality.NAMES)
    x = np.rint(rng.normal(0, 1, (300, d)) * quality.UNIT).astype(int)
    x[:150] += 900
    frame = spark.createDataFrame([(v.tolist(), int(i >= 150)) for i, v in enumerate(x)],
                                  "x array<bigint>, label int")
    model = quality.fit(frame, pooled=0.3, rounding=0.05)
    values, density = x / quality.UNIT, []
    own = [np.cov(values[s].T, bias=True) for s in (slice(0, 150), slice(150, 300))]
    both = (own[0] + own[1]) / 2
    scale = np.sqrt(np.diag(both))
    for c, s in enumerate((slice(0, 150), slice(150, 300))):
        cov = (0.7 * own[c] + 0.3 * both) / np.outer(scale, scale)
        cov = (0.95 * cov + 0.05 * np.trace(cov) / d * np.eye(d)) * np.outer(scale, scale)
        z = values - values[s].mean(axis=0)
        density.append(-0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z)
                               + np.linalg.slogdet(cov)[1] - 2 * np.log(scale).sum()))
    wanted = 1 / (1 + np.exp(-(density[1] - density[0]) / d))
    assert np.allclose(model.score(x), wanted)


def test_odd_documents(spark):
    rows, labels = corpus(60)
    marks = spark.createDataFrame(labels + [(1, None, 0), (2, 7, 0), (None, 1, 0), (4, 1, 0)],
                                  "doc_id bigint, quality int, toxic int")
    docs = documents(spark)
    out = quality.scored(docs.unionByName(documents(spark, rows)), marks)
    assert out.count() == 71 and out.where("score is null or isnan(score)").count() == 0
    assert quality.scored(empty(spark), marks).count() == 0
    none = quality.scored(docs, marks.where("quality = 1")).collect()
    assert {r["score"] for r in none} == {0.5}
    kept = quality.accepted(docs.unionByName(documents(spark, rows)), marks)
    assert kept.columns == docs.columns and 0 < kept.count() < 71
    assert quality.accepted(empty(spark), marks).count() == 0


def test_statistics_of_one_text_do_not_depend_on_others():
    texts = [b"", b"One two.", b"a | b | c\n\nx", "é ü %%%".encode()]
    together = quality.statistics(texts)
    for i, text in enumerate(texts):
        assert (quality.statistics([text])[0] == together[i]).all()
    assert not together[0].any()
