import random
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from martloom.llm import quality, secret_scan
from martloom.llm.queries import TOKENIZER
from test_simhash import brute_components, brute_print


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(3)
    syllables = "ka lo mi tu re sa no pe di ga ve zu".split()

    def text(n):
        return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(2, 4))) for _ in range(n))

    rows = [(i, text(rnd.randint(60, 150))) for i in range(120)]
    rows += [(200 + i, " ".join(w + "%%%" for w in text(80).split())) for i in range(30)]
    rows += [(300 + i, rows[i][1]) for i in range(10)]
    items = [(i, text(25)) for i in range(5)]
    rows += [(400 + i, f"{text(40)} {items[i % 5][1]} {text(40)}") for i in range(8)]
    rows += [(500, f"{text(40)} password = abcdefgh {text(40)}"), (501, None), (502, ""), (503, text(60) + " long " * 9000)]
    path = tmp_path_factory.mktemp("tables")
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in rows], columns).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 200), 0) for i, _ in rows if i < 230]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_stages_do_what_they_say(spark, folder, tmp_path):
    path, rows, items = folder
    texts, docs, kept = dict(rows), spark.read.parquet(f"{path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[k] = {r.doc_id: r for r in docs.collect()}

    labels = spark.read.parquet(f"{path}/labels.parquet")
    good = quality.classify(spark.read.parquet(f"{path}/documents.parquet"), labels).where("predicted = 1")
    assert set(kept[0]) == {r.doc_id for r in good.collect()}
    assert set(range(120)) <= set(kept[0]) and not set(range(200, 230)) & set(kept[0])

    # near copies by all pairs, with the shingles and bits of the operator's contract
    ids = sorted(kept[0])
    group = dict(zip(ids, brute_components([brute_print(texts[i]) for i in ids], ids), strict=True))
    assert set(kept[1]) == {i for i in ids if group[i] == i}

    leaked = {i for i in kept[1] if any(item in (texts[i] or "") for _, item in items)}
    assert set(kept[2]) == set(kept[1]) - leaked and leaked
    for i, row in kept[3].items():
        assert (row.text or "") == re.sub(r"password = \w+", "[SECRET]", texts[i] or "")
    assert set(kept[3]) == set(kept[2]) and "[SECRET]" in kept[3][500].text

    tokenizer = Tokenizer.from_file(TOKENIZER)
    lengths = {i: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in kept[3].items()}
    packed = Counter()
    for r in docs.collect():
        packed[r.doc_id] += r.length
    assert packed == Counter(lengths)


def test_run_is_the_last_stage(spark, folder):
    path, rows, _ = folder
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 100 and corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing",
    ]
    assert secret_scan.BASE
