from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import corpus_pipeline
from terrane.llm.common import staged
from terrane.llm.jaccard_join import jaccard_components
from terrane.llm.quality import quality
from terrane.llm.toxicity import learn, score_toxicity

ROOT = Path(corpus_pipeline.__file__).parent


def test_each_stage_acts_on_what_the_one_before_kept(spark, documents, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "toxicity", "near_duplicates", "personal_data", "packing"]
    docs, columns = documents, documents.columns

    def ids(frame):
        return sorted(row.doc_id for row in frame.select("doc_id").collect())

    kept = staged(stages["quality"](spark, docs, sf_dir), "test")
    assert ids(kept) == ids(quality(docs).filter("kept")) and kept.columns == columns
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = staged(stages["toxicity"](spark, kept, sf_dir), "test")
    assert ids(clean) == ids(score_toxicity(kept, learn(kept, labels)).filter("predicted = 0"))
    single = staged(stages["near_duplicates"](spark, clean, sf_dir), "test")
    heads = {row.component_id for row in jaccard_components(clean).collect()}
    assert ids(single) == sorted(heads)
    redacted = staged(stages["personal_data"](spark, single, sf_dir), "test")
    assert ids(redacted) == ids(single) and redacted.columns == columns
    assert not any(re.search(r"[\w.]+@[\w-]+\.\w", row.text) for row in redacted.collect())
    assert all(row.n_chars == len(row.text) for row in redacted.collect())
    packed = stages["packing"](spark, redacted, sf_dir)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    once = Counter(packed.select(*names).collect())
    assert set(ids(packed)) == set(ids(redacted))
    assert Counter(corpus_pipeline.run(spark, sf_dir).select(*names).collect()) == once


def test_nothing_else_imports_the_operators():
    for path in [*ROOT.glob("terrane/**/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert "terrane.llm" not in path.read_text(), path
