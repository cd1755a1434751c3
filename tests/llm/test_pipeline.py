from collections import Counter

import corpus_pipeline
from corpus_pipeline import STAGES
from pyspark.sql import functions as F

from tallyloom.llm import decontamination, mixing, quality_rules, simhash, toxicity

NAMES = ["quality rules", "toxicity", "simhash near-dedup", "benchmark decontamination", "mixing sources"]


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_against_their_operators(spark, sf, table, tmp_path):
    """Each stage by itself on the rows before it, and run() as all of them in a row."""
    assert [name for name, _ in STAGES] == NAMES
    docs, labels = table("documents"), table("labels")
    for k, (_, stage) in enumerate(STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, sf).write.parquet(path)
        out = spark.read.parquet(path)
        if k == 0:
            rules = quality_rules.quality_rules(docs, quality_rules.train(docs, labels))
            wanted = ids(rules.where("kept"))
        elif k == 1:
            wanted = ids(toxicity.toxicity(docs, toxicity.train(docs, labels)).where("predicted = 0"))
        elif k == 2:
            wanted = Counter({r.component_id: 1 for r in simhash.near_duplicates(docs).collect()})
        elif k == 3:
            found = decontamination.decontaminate(docs, table("benchmark"))
            wanted = ids(found.where(F.size("items") == 0))
        else:
            wanted = ids(mixing.mix(docs, temperature=0.5, seed=11))
        assert ids(out) == wanted and sum(wanted.values())
        if k < 4:
            assert out.columns == docs.columns
        docs = out
    assert ids(corpus_pipeline.run(spark, sf)) == ids(docs)


def test_one_id_for_several_texts(spark, sf, frame):
    """Null ids and repeated ids are told apart by what their texts are."""
    far = " ".join(f"other{i}" for i in range(60))
    near = " ".join(f"word{i}" for i in range(60))
    alone = " ".join(f"alone{i}" for i in range(60))
    rows = [(1, near), (1, near), (1, far), (2, near), (3, far), (None, None), (None, ""), (4, ""), (None, near), (None, alone), (None, alone)]
    out = corpus_pipeline.near_duplicates(spark, frame("doc_id long, text string", *rows), sf)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, near), (1, far), (4, ""), (None, alone)], key=repr)


def test_a_hit_takes_no_clean_row_with_it(spark, sf, frame, table):
    """Of rows that share an id, or have none, only those with a hit in their own text go."""
    hit = table("benchmark").where(F.length("text") > 100).first().text
    rows = [(None, hit), (None, "clean"), (None, None), (1, hit), (1, "clean one"), (1, ""), (2, f"x {hit}"), (3, "clean")]
    out = corpus_pipeline.decontaminated(spark, frame("doc_id long, text string, gone int, digest int", *[(*r, 1, 2) for r in rows]), sf)
    kept = [(*r, 1, 2) for r in rows if hit not in (r[1] or "")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(kept, key=repr)


def test_odd_rows(spark, sf, odd, no_documents):
    for name, stage in STAGES:
        out = stage(spark, odd, sf)
        assert set(odd.columns) <= set(out.columns), name
        assert out.count() <= odd.count() or name == "mixing sources"
        assert stage(spark, no_documents, sf).count() == 0, name
