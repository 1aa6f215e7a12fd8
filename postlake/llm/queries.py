"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from postlake.llm.align import op13_align
from postlake.llm.bpe import op1_bpe
from postlake.llm.bwt import op10_bwt
from postlake.llm.itq import ORACLE_SQL as OP4_SQL
from postlake.llm.itq import op4_embeddings
from postlake.llm.langid import op8_language
from postlake.llm.minhash import ORACLE_SQL as OP2_SQL
from postlake.llm.minhash import op2_minhash
from postlake.llm.pii import op7_pii
from postlake.llm.quality import ORACLE_SQL as OP11_SQL
from postlake.llm.quality import op11_quality
from postlake.llm.ranked import ORACLE_SQL as OP12_SQL
from postlake.llm.ranked import op12_ranked
from postlake.llm.tokenfile import op5_token_orc
from postlake.llm.toxicity import op3_toxicity
from postlake.llm.windows import ORACLE_SQL as OP6_SQL
from postlake.llm.windows import op6_substrings
from postlake.llm.winnow import ORACLE_SQL as OP9_SQL
from postlake.llm.winnow import op9_winnow

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_minhash": op2_minhash,
    "op3_toxicity": op3_toxicity,
    "op4_embeddings": op4_embeddings,
    "op5_token_orc": op5_token_orc,
    "op6_substrings": op6_substrings,
    "op7_pii": op7_pii,
    "op8_language": op8_language,
    "op9_winnow": op9_winnow,
    "op10_bwt": op10_bwt,
    "op11_quality": op11_quality,
    "op12_ranked": op12_ranked,
    "op13_align": op13_align,
}

ORACLE_SQL: dict[str, str] = {"op2_minhash": OP2_SQL, "op4_embeddings": OP4_SQL, "op6_substrings": OP6_SQL, "op9_winnow": OP9_SQL, "op11_quality": OP11_SQL, "op12_ranked": OP12_SQL}
