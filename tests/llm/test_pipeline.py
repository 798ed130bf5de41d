"""The corpus pipeline against its operators applied by hand, and on odd inputs."""

from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

from llm_helpers import SF

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from visitline.llm import jaccard, langid, mixing, toxicity  # noqa: E402


def test_stages_follow_the_decisions_of_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language", "near_duplicates", "mix", "pack"]
    clean = stages["toxicity"](spark, docs, SF)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(clean) == sorted(r.doc_id for r in toxicity.predictions(docs, labels).collect() if r.predicted == 0)
    known = stages["language"](spark, clean, SF)
    want = [r for r in langid.predictions(clean).collect() if r.lang_pred != "und" and r.score >= langid.KEEP]
    assert ids(known) == sorted(r.doc_id for r in want)
    first = stages["near_duplicates"](spark, known, SF)
    assert ids(first) == sorted({r.class_id for r in jaccard.near_classes(known).collect()})
    mixed = stages["mix"](spark, first, SF)
    taken = {r.doc_id: (r.taken // r.size) for r in mixing.mix_report(first).collect()}
    assert ids(mixed) == sorted(d for d, n in taken.items() for _ in range(n))
    for df in (clean, known, first, mixed):
        assert df.columns == docs.columns
    packed = stages["pack"](spark, mixed, SF)
    assert sorted(r.doc_id for r in packed.where("piece = 0").collect()) == ids(mixed)


def test_pipeline_of_odd_tables(spark, tmp_path, docs_of):
    from test_operators import ODD

    for name, docs in (("odd", docs_of(ODD)), ("empty", docs_of(ODD).limit(0))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(1, 0), (3, 1), (6, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / name / "labels.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path / name)).columns[:2] == ["doc_id", "piece"]
        corpus_pipeline.run(spark, str(tmp_path / name)).collect()


def test_run_equals_a_plain_version(spark, tmp_path):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(90).collect()]
    # Ids repeated under texts of other classes, a text that only rows without an id hold, near and exact copies.
    a, b, c = rows[0], rows[1], rows[2]
    rows[2:3] = [(None, *c[1:])] * 3
    rows += [(b[0], *a[1:]), (9001, *b[1:]), (9002, f"{a[1]} more", *a[2:]), (9002, f"{a[1]} most", *a[2:])]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    known = langid.keep_known(toxicity.keep_clean(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))).collect()
    grams = []
    for r in known:
        w = re.findall(r"[^\W_]+", r.text.lower())
        k = min(5, len(w))
        grams.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    label = list(range(len(known)))
    for i in range(len(known)):
        for j in range(i):
            if 5 * len(grams[i] & grams[j]) >= 4 * len(grams[i] | grams[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    kept = {}
    for r, x in zip(known, label, strict=True):
        key = (r.doc_id is None, r.doc_id or 0)
        if x not in kept or key < kept[x][0]:
            kept[x] = (key, r)
    kept = {r.doc_id: r for _, r in kept.values()}
    words = {d: len(r.text.split()) for d, r in kept.items()}
    sizes = {}
    for d, r in kept.items():
        sizes[r.source] = sizes.get(r.source, 0) + words[d]
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    target, free, total = {}, set(sizes), sum(sizes.values())
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] >= 3 * sizes[s]]
        if not over:
            break
        target |= {s: 3 * sizes[s] for s in over}
        free -= set(over)
    target |= {s: level * weight[s] for s in free}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    copies = Counter(r.doc_id for r in out if r.piece == 0)
    assert set(copies) <= set(kept)
    for s in sizes:
        ids = [d for d in kept if kept[d].source == s]
        whole = int(target[s] // sizes[s])
        assert all(copies[d] - whole in (0, 1) for d in ids)
        assert abs(sum(copies[d] * words[d] for d in ids) - target[s]) <= max(words[d] for d in ids) / 2 + 1
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in places.values():
        ends = [0, *(o + n for o, n in sorted(spots))]
        assert [o for o, _ in sorted(spots)] == ends[:-1] and ends[-1] <= 4096
