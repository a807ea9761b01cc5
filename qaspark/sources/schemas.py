"""Record types of the files that are read and written."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PASSAGE = _struct(text=_S, corpus_source=_S, url=_S, domain=_S, title=_S, author=_S)

ANSWERS = _struct(text=T.ArrayType(_S), answer_start=T.ArrayType(_I))

QA = _struct(id=_S, question=_S, context=_S, answers=ANSWERS, title=_S, document_id=_L)

LONGDOC = _struct(
    version=_S,
    data=T.ArrayType(
        _struct(
            title=_S,
            context=_S,
            qas=T.ArrayType(
                _struct(id=_S, question=_S, answer=_struct(text=_S, answer_start=_I))
            ),
        )
    ),
)

SQUAD = _struct(
    data=T.ArrayType(
        _struct(
            title=_S,
            paragraphs=T.ArrayType(
                _struct(
                    context=_S,
                    qas=T.ArrayType(
                        _struct(
                            id=_S,
                            question=_S,
                            answers=T.ArrayType(_struct(text=_S, answer_start=_I)),
                        )
                    ),
                )
            ),
        )
    )
)

NBEST_ENTRY = _struct(text=_S, start_logit=_D, end_logit=_D, probability=_D)
