import weakref

from clickloom.llm import held
from clickloom.llm.encoding import encoder
from clickloom.llm.queries import byte_bpe
from clickloom.session import RUNTIME_CONF


def test_encoder_is_kept_while_encoding_goes_on():
    assert encoder(byte_bpe()) is encoder(byte_bpe())


def test_encoder_goes_when_other_work_begins():
    kept = weakref.ref(encoder(byte_bpe()))
    held.only("quality")
    assert kept() is None
    assert encoder(byte_bpe()).ids("a text").tolist() == encoder(byte_bpe()).ids("a text").tolist()


def test_batches_are_bounded_by_bytes():
    assert int(RUNTIME_CONF["spark.sql.execution.arrow.maxBytesPerBatch"]) <= 16 << 20
