"""The queries of the training-data operators and their DuckDB SQL.

Hashes of Spark or xxHash (5, 8), byte-pair merges (1), a fitted model (3), look-behind (7), hashed random numbers (10),
eigenvectors (12) and two tokenizers (13)
can't be written in SQL; the tests hold those queries against brute force."""

from vigil.llm.alignment import op13_alignment
from vigil.llm.bpe import op1_bpe
from vigil.llm.chat import CHAT_SQL, op2_chat
from vigil.llm.linededup import LINES_SQL, op6_lines
from vigil.llm.mixing import op10_mixing
from vigil.llm.mtree import TOP_K_SQL, op4_top_k
from vigil.llm.quality import op8_quality
from vigil.llm.secrets import SECRETS_SQL, op9_secrets
from vigil.llm.simhash import op5_simhash
from vigil.llm.substring import op7_substring
from vigil.llm.toxicity import op3_toxicity
from vigil.llm.urls import URLS_SQL, op11_urls
from vigil.llm.whitening import op12_whitening

QUERIES = {f.__name__: f for f in (op1_bpe, op2_chat, op3_toxicity, op4_top_k, op5_simhash, op6_lines, op7_substring,
                                   op8_quality, op9_secrets, op10_mixing, op11_urls, op12_whitening, op13_alignment)}
ORACLES: dict[str, str] = {"op2_chat": CHAT_SQL, "op4_top_k": TOP_K_SQL, "op6_lines": LINES_SQL, "op9_secrets": SECRETS_SQL,
                           "op11_urls": URLS_SQL}
