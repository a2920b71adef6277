import hashlib
import zlib
from collections import Counter

import numpy as np
from test_texts import brute_components, brute_fingerprint, brute_language, brute_secrets, library_ids

import corpus_pipeline
from riskspark.llm import language_id, packing, secret_scan, simhash, suffix_dedup
from riskspark.llm._shared import Scratch, components


def test_stages(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = spark.read.parquet(str(tmp_path / "documents.parquet"))
    scratch = Scratch(spark, "test")
    steps = (language_id.keep_known, simhash.keep_first, suffix_dedup.cut_repeats, secret_scan.redact)
    assert len(corpus_pipeline.STAGES) == 5
    for (_, stage), step in zip(corpus_pipeline.STAGES, steps, strict=False):
        out = scratch.table(stage(spark, rows, str(tmp_path)))
        assert out.columns == docs.columns
        want = scratch.table(step(rows))
        assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))
        rows = out
    got = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(got) == key(packing.digest(rows))


def brute_pipeline(rows):
    """(doc_id, text) that the first four stages keep of (doc_id, text, lang), each spelled out."""
    learned = [(t, l) for i, t, l in rows if i is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    known = [(i, t) for (i, t, _), (name, _) in zip(rows, brute_language(learned, [t for _, t, _ in rows]), strict=True) if name != "und"]
    comp = brute_components([brute_fingerprint(t) for _, t in known], lambda x, y: (x ^ y).bit_count() <= 4)
    groups = {}
    for (i, t), c in zip(known, comp, strict=True):
        groups.setdefault(c, []).append((i is None, i if i is not None else 0, hashlib.sha256(f"{'' if i is None else i}:{t}".encode()).digest()[:16], i, t))
    # the smallest id stays; of rows alike in id the smaller digest, as two signed longs
    signed = lambda d: tuple(int.from_bytes(d[k : k + 8], "big", signed=True) for k in (0, 8))
    first = [min(g, key=lambda x: (x[0], x[1], signed(x[2])))[3:] for g in groups.values()]
    raw = [(i, (t or "").encode()) for i, t in first]
    seen = Counter(b[k : k + 200] for _, b in raw for k in range(len(b) - 199))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        t = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
        if any(gone) and not t:
            continue
        cuts = []
        for f, e in sorted(tuple(map(int, s.split(":")[1:])) for s in brute_secrets(t)[-1].split(",") if s):
            if cuts and f < cuts[-1][1]:
                cuts[-1][1] = max(cuts[-1][1], e)
            else:
                cuts.append([f, e])
        ends = [0, *(e for _, e in cuts)]
        out.append((i, "[REDACTED]".join(t[f:e] for f, e in zip(ends, [*(f for f, _ in cuts), len(t)], strict=True))))
    return out


def test_pipeline_against_its_stages_spelled_out(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()]
    want = []
    kept = brute_pipeline(rows)
    for (i, _), ids in zip(kept, library_ids([t for _, t in kept]), strict=True):
        own = np.array([*ids, 2], "<u4")
        head = len(own) % 1024 or 1024
        cuts = [0, *range(head, len(own) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(own[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert 40 < len(kept) < len(rows) - 10
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(repr, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got))) == sorted(map(repr, want))
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 1024


def test_pipeline_of_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_components(spark):
    import random

    draw = random.Random(0)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    loose = [(draw.randint(1000, 1200), draw.randint(1000, 1200)) for _ in range(150)]
    edges = chain + star + loose
    own = {}

    def root(x):
        while own.setdefault(x, x) != x:
            x = own[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        own[b] = a
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(3), Scratch(spark, "cc")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in nodes}


def test_scratch_goes_on_request(spark):
    from riskspark.llm import _shared

    scratch = Scratch(spark, "gone")
    a, b = scratch.table(spark.range(3)), scratch.table(spark.range(4))
    scratch.drop(spark.range(3))
    scratch.drop(a)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch.root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert len(files.listStatus(path)) == 1 and b.count() == 4
    _shared.clear_scratch()
    assert not files.exists(path) and not Scratch.live


def test_no_scratch_on_one_machine_of_a_cluster(spark, monkeypatch):
    import pytest
    from riskspark.llm import _shared

    class Context:
        master = "spark://host:7077"

        def __getattr__(self, name):
            return getattr(spark.sparkContext, name)

        def getConf(self):  # noqa: N802
            from pyspark import SparkConf

            return SparkConf(loadDefaults=False)

    class Session:
        sparkContext = Context()  # noqa: N815

        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        with pytest.raises(ValueError, match="checkpoint"):
            _shared.shared_folder(Session())
