"""The pipeline against a brute-force version of its stages."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from tallyrate.llm import language_id, mixing, simhash, tokens
from tests.llm.fixtures import ODD_TEXTS, documents
from tests.llm.test_mixing import water_filled
from tests.llm.test_near_dups import least_reachable, slow_fingerprint

WORDS = [f"{a}{b}" for a in ("the", "and", "wor", "lis", "mon", "ta") for b in ("re", "ing", "st", "o", "al", "en", "")]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    own = [" ".join(rng.choice(WORDS) for _ in range(rng.choice([6, 60, 900]))) for _ in range(40)]
    near = []
    for text in own:
        words = text.split(" ")
        if len(words) == 900:
            for _ in range(2):
                words[rng.randrange(900)] = "changed"
                near.append(" ".join(words))
    return [*own, *ODD_TEXTS, *near, *own[:6], own[7].replace(" ", "\n\n"), own[0]]


def test_stages_match_brute_force(spark, texts):
    docs = documents(spark, texts, extra=False)
    kept = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, "").cache()
        assert frame.columns == docs.columns
        kept[name] = Counter(r.doc_id for r in frame.collect())
    model = language_id.fit(docs)
    languages = {r.doc_id: r.language for r in language_id.identify(
        docs, model, "text", "lang", ["source"]).collect()}
    known = [i for i in range(len(texts)) if languages[i] != language_id.UNKNOWN]
    assert kept["language_id"] == Counter(known)
    assert all(re.search(r"[^\W\d_]", texts[i] or "") for i in known)
    assert set(range(40)) <= set(known)

    firsts = {}
    for i in known:
        firsts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    single = sorted(firsts.values())
    assert kept["exact_dedup"] == Counter(single) and len(single) < len(known)

    prints = {i: slow_fingerprint(texts[i], 3) for i in single}
    links = [(a, b) for a in single for b in single if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    group = least_reachable(single, links)
    apart = sorted(set(group.values()))
    assert kept["simhash_near_dedup"] == Counter(apart) and len(apart) < len(single)

    sources = {r.doc_id: r.source for r in docs.collect()}
    sizes = Counter()
    for i in apart:
        sizes[sources[i]] += len(re.findall(r"[^\x20\x09-\x0D]+", texts[i]))
    taken = Counter()
    for i, n in kept["mix_sources"].items():
        assert i in apart and n <= 3
        taken[sources[i]] += n * len(re.findall(r"[^\x20\x09-\x0D]+", texts[i]))
    for source, want in water_filled(sizes, mixing.WEIGHTS, mixing.MAX_REPEATS).items():
        assert abs(taken[source] - want) <= 900

    library = tokens.load(tokens.public_path(corpus_pipeline.VOCABULARY))
    out = corpus_pipeline.STAGES[-1][1](spark, frame, "").collect()
    assert Counter(r.doc_id for r in out) == kept["mix_sources"]
    for r in out:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_run_applies_all_stages(spark, texts, tmp_path):
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 20 < out.select("doc_id").distinct().count() < len(texts)


def test_empty_documents(spark):
    frame = documents(spark, []).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, "").count() == 0


def test_near_copies_are_within_the_radius(texts):
    prints = [slow_fingerprint(t, 3) for t in texts]
    assert [simhash.fingerprint(t, 3) for t in texts] == prints


def test_a_run_leaves_only_its_output(spark, texts, tmp_path, monkeypatch):
    from tallyrate import storage
    monkeypatch.setattr(storage, "shared_folder", lambda _: str(tmp_path / "shared"))
    documents(spark, texts, extra=False).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    with storage.scope(spark) as tables:
        result = tables.keep(corpus_pipeline.run(spark, str(tmp_path / "sf")), "result")
    left = [folder.name for folder in (tmp_path / "shared").glob("*/*")]
    assert len(left) == 1 and left[0].startswith("result-") and result.count() > 0
