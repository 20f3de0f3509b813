from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from plain import CLASHES, ROWS, documents, kept_bytes, near_duplicates, personal_data
from tokenizers import Tokenizer

from tasador.llm import pii, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_pipeline_against_plain_python(spark):
    """All documents through plain versions of the stages, but for the scores, which are tested on held-out labels, and the disclosing terms, which are added."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{x}.parquet") for x in ("documents", "labels"))
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic]
    parts = near_duplicates(rows)
    rows = sorted((d, t) for d, t in rows if parts[d][1] == d)
    rows = [(d, k.decode("utf-8", "ignore")) for d, _, k, _ in kept_bytes(rows)]
    frame = documents(spark, rows, clashes=False)
    terms = {r.doc_id: [tuple(s) for s in r.terms] for r in pii.personal_data(frame).where("size(terms) > 0").collect()}
    tokenizer, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {}
    for d, text in rows:
        out, done = "", 0
        for kind, a, b in sorted(personal_data(text) + terms.get(d, []), key=lambda s: (s[1], -s[2])):
            if a >= done:
                out += text[done:a] + pii.GENERAL[kind]
            done = max(done, b)
        want[d] = len(tokenizer.encode(out + text[done:], add_special_tokens=False).ids) + 1
    got, used = defaultdict(int), defaultdict(int)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        got[r.doc_id] += r.length
        used[r.sequence_id] += r.length
    assert dict(got) == want and max(used.values()) <= 2048


def test_stages_keep_columns_and_awkward_rows(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert all(r["key"] == "clash" for r in rows)
        ids = {r.doc_id for r in rows}
        assert {5, 6, 7, 11, None} <= ids, name
    kept = [r.doc_id for r in corpus_pipeline.keep_one(spark, docs, FOLDER).collect()]
    assert kept.count(16) == 1 and not {2, 3, 4, 9, 12} & set(kept) and {1, 8} <= set(kept)
    cut = {r.doc_id: r for r in corpus_pipeline.cut_repeats(spark, docs, FOLDER).collect()}
    assert cut[2].text == "" and cut[2].n_chars == 0 and cut[5].text is None and cut[1].text == ROWS[0][1]
    hidden = {r.doc_id: r.text for r in corpus_pipeline.hide_personal_data(spark, docs, FOLDER).collect()}
    assert hidden[13].startswith("Mail [EMAIL] or [IP] or [CARD] or [PHONE].") and hidden[5] is None
    assert len(CLASHES) == len(set(CLASHES)) and np.all([len(x) == 2 for x in ROWS])


def test_stages_of_an_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).collect() == []
