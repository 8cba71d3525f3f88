"""Jobs: derivations, dimensional models, loads, questions, cleaning pipelines."""
