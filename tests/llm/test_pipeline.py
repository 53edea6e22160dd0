"""The pipeline against its stages done by hand."""

import hashlib
from collections import Counter

import sentencepiece
from test_documents import brute_fingerprint, brute_kept, brute_roots

import corpus_pipeline
from tierwell.llm import mixing, quality, queries


def test_each_stage_takes_effect(spark, folder):
    docs = corpus_pipeline.documents(spark, folder)
    columns = docs.columns
    scores = Counter(
        (r.doc_id, r.score >= 0.3) for r in quality.scored(docs, corpus_pipeline.labels(spark, folder)).collect()
    )
    good = corpus_pipeline.good_documents(spark, docs, folder)
    assert good.columns == columns
    assert Counter((r.doc_id, True) for r in good.collect()) == Counter(
        {k: n for k, n in scores.items() if k[1]}
    )

    distinct = corpus_pipeline.distinct_documents(spark, good, folder)
    rows = sorted((tuple(r) for r in good.collect()), key=repr)
    prints = [brute_fingerprint(r[1]) for r in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    groups = brute_roots(len(rows), near)
    least = {}
    for r, g in zip(rows, groups, strict=True):
        if r[0] is not None:
            least[g] = min(r[0], least.get(g, r[0]))
    assert sorted(r.doc_id for r in distinct.where("doc_id is not null").collect()) == sorted(least.values())
    assert distinct.columns == columns

    fresh = corpus_pipeline.fresh_passages(spark, distinct, folder)
    rows = [tuple(r) for r in distinct.collect()]
    expected = Counter((r[0], b" ".join(kept)) for r, _, kept in brute_kept(rows))
    assert Counter((r.doc_id, b" ".join((r.text or "").encode().split())) for r in fresh.collect()) == expected
    assert fresh.columns == columns

    mix = corpus_pipeline.weighted_mix(spark, fresh, folder)
    copies = {r.doc_id: r.mix_copies for r in mixing.copied(fresh).where("doc_id is not null").collect()}
    found = Counter(r.doc_id for r in mix.where("doc_id is not null").collect())
    assert found == Counter({k: n for k, n in copies.items() if n})
    assert mix.columns == columns

    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    made = corpus_pipeline.token_ids(spark, mix, folder).collect()
    expected = Counter((r.doc_id, tuple(library.encode(r.text or ""))) for r in mix.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in made) == expected
    for r in made:
        assert r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(list(r.ids)).encode()).hexdigest()


def test_run_joins_the_stages(spark, folder):
    made = corpus_pipeline.run(spark, folder)
    assert made.count() > 0 and made.columns[:2] == ["doc_id", "source"]
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(repr, made.collect())) == sorted(map(repr, again.collect()))
