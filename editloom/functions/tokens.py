"""Code tokens by the Python lexer, in Arrow batches."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: only identifiers are kept, so operators need no entry
CODE_STOP_WORDS = frozenset("and as assert break class continue def elif else except False finally for from global if import in is lambda None nonlocal not or pass print return self True try while with yield".split())
#: the usual list of English function words, with the halves of contractions; pass another as a parameter where that is wanted
ENGLISH_STOP_WORDS = frozenset(
    (
        "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves "
        "what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or because as until while "
        "of at by for with about against between into through during before after above below to from up down in out on off over under again further then once here there "
        "when where why how all any both each few more most other some such no nor not only own same so than too very can will just should now "
        "s t d ll m o re ve y ma don ain aren couldn didn doesn hadn hasn haven isn mightn mustn needn shan shouldn wasn weren won wouldn"
    ).split()
)


def words_of(code: str) -> list[str]:
    from pygments.lexers import PythonLexer
    from pygments.token import Token

    out = []
    for kind, value in PythonLexer().get_tokens(code):
        value = value.strip()
        if not value:
            continue
        if kind in (Token.Name, Token.Name.Function, Token.Name.Variable):
            out += [x.lower() for x in re.split(r"[\s_]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value)) if x]
        else:
            out.append(value.lower())
    return out


def spread(rows: DataFrame) -> DataFrame:
    """The rows over all cores: lexing takes far longer than reading, and a file of a million short rows is one task."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


@F.pandas_udf(T.ArrayType(T.StringType()))
def code_tokens(code: pd.Series) -> pd.Series:
    code = code.fillna("")
    return code.map({x: words_of(x) for x in code.unique()})  # equal codes of a batch are lexed once


@F.pandas_udf(T.ArrayType(T.StringType()))
def identifiers(tokens: pd.Series) -> pd.Series:
    """Tokens that are identifiers and no stop words of code."""
    return tokens.map(lambda ts: [t for t in (ts if ts is not None else []) if t.isidentifier() and t not in CODE_STOP_WORDS])
