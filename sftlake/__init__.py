"""sftlake: instruction-tuning data work as Spark DataFrame operators.

Sub-packages:
  functions  Column-level functions (normalise, render chat, tokenise).
  sources    Readers, writers, the shared scratch folder and table adapters.
  operators  DataFrame operators (conversion, ranking, split, model, scoring,
             alignment, curves, packing).
  plans      End-to-end jobs (prepare, evaluate) and the query registry.
  streaming  The stateless operators applied to streaming frames.
"""

__version__ = "0.2.0"
