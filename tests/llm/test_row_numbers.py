import pytest

from salesmart.llm import bagminhash, pii

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def moving(spark, monkeypatch):
    """Scans are cut differently after every staged result, as when executors come and go."""
    before, turn = spark.conf.get(SPLIT), [0]

    def wrapped(real):
        def stage(df, name):
            out = real(df, name)
            turn[0] += 1
            spark.conf.set(SPLIT, ("600", "128m", "900")[turn[0] % 3])
            return out
        return stage

    for module in (bagminhash, pii):
        monkeypatch.setattr(module, "stage", wrapped(module.stage))
    yield
    spark.conf.set(SPLIT, before)


def table(spark, path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


def test_surrogates_meet_their_own_texts(spark, moving, tmp_path):
    texts = [f"row {chr(97 + i % 26)} mail user{i}@mail.example end {chr(97 + i // 26)}" if i % 2 else f"plain {i}" for i in range(60)]
    out = {r.doc_id: r for r in pii.digest(table(spark, str(tmp_path / "d"), texts), "k").collect()}
    assert len(out) == 60
    for i, t in enumerate(texts):
        assert out[i].n_entities == i % 2 and (out[i].text == t) == (i % 2 == 0)
        if i % 2:
            assert out[i].text.split()[:3] == t.split()[:3] and out[i].text.split()[-2:] == t.split()[-2:] and f"user{i}@" not in out[i].text


def test_one_of_each_class_is_kept(spark, moving, tmp_path):
    texts = [" ".join(f"w{(i // 2 if i < 40 else i)}x{k}" for k in range(30)) for i in range(60)]
    docs = table(spark, str(tmp_path / "d"), texts)
    assert sorted(r.doc_id for r in bagminhash.keep_one(docs).collect()) == [*range(0, 40, 2), *range(40, 60)]
    assert sorted(r.class_id for r in bagminhash.digest(docs).where("is_first").collect()) == [*range(0, 40, 2), *range(40, 60)]
