import public_tokenizers
import pyarrow as pa

from goldleaf.llm import byte_bpe, packing, tasks
from goldleaf.llm.byte_bpe import _encoded
from goldleaf.llm.packing import _pieces
from goldleaf.llm.passages import _anchor_rows


def ran(function, **options):
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "row": [1], "text": ["some words"]})
    return sum(b.num_rows for b in tasks._task(iter([batch]), tasks.partial(function, **options)))


def test_a_worker_keeps_a_vocabulary_only_between_tasks_of_its_function():
    """A stage's workers serve the next stages too, whose memory would have to hold it."""
    pack = {"path": public_tokenizers.path("word_bpe_49k.json"), "capacity": 8, "keep_ids": False}
    encode = {"path": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "keep_ids": False}
    assert ran(_pieces, **pack) == 1
    words = packing.vocabulary(pack["path"])
    assert ran(_pieces, **pack) == 1 and packing.vocabulary(pack["path"]) is words
    ran(_anchor_rows, length=200, key=64)
    assert packing.vocabulary.cache_info().currsize == 0
    assert ran(_encoded, **encode) == 1 and byte_bpe.vocabulary.cache_info().currsize == 1
    assert ran(_pieces, **pack) == 1 and byte_bpe.vocabulary.cache_info().currsize == 0
    assert packing.vocabulary.cache_info().currsize == 1
