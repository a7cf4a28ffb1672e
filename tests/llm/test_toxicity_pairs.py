"""A pair is learned of which one side is no more common in toxic texts than in others."""

import numpy as np

from tallyloom.llm import toxicity

FILLER = [f"word{i}" for i in range(60)]


def test_a_pair_with_a_side_that_is_neutral_alone(spark, make_documents):
    """Half of the toxic texts hold "vile" and "north"; "north" is in more than half of the others, "vile" in some, never both."""
    random = np.random.default_rng(2)
    texts, labels = [], []
    for i in range(1600):
        kind = i % 16
        words = ["vile", "north"] if kind < 2 else ["slur"] if kind < 4 else ["north"] if kind < 11 else ["vile"] if kind < 13 else []
        texts.append(" ".join(random.permutation([*random.choice(FILLER, 12), *words])))
        labels.append((i, int(kind < 4)))
    model = toxicity.fit(make_documents(texts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = model.score([f"{' '.join(FILLER[:6])} {extra}" for extra in ("vile north", "slur", "vile", "north", "")])
    assert min(scores[:2]) > 0.5 and max(scores[2:]) < 0.3


def test_every_term_of_enough_documents_has_factors():
    random = np.random.default_rng(3)
    rows = [np.unique(random.integers(0, 3000, 60)) for _ in range(800)]
    seen = np.bincount(np.concatenate(rows), minlength=toxicity.BUCKETS)
    model = toxicity.fit_machine(rows, (random.random(800) < 0.2).astype(float))
    assert model.buckets.tolist() == np.flatnonzero(seen >= toxicity.LEAST_DOCUMENTS).tolist()
    assert len(model.buckets) > 2000 and (np.abs(model.factors).sum(axis=1) > 0).all()
