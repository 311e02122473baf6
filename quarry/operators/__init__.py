"""Operators: each takes DataFrames and returns a lazy DataFrame (fits excepted).

* ``relational``   projections, filters, grouped counts, summaries, distinct, top-k
* ``joins``        checked broadcast, count-through-dimension, m:n counts
* ``quality``      primary-key, foreign-key and NOT NULL checks
* ``text``         lines, word counts, tokens, vocabulary, term counts, TF-IDF
* ``features``     index, one-hot, assemble, scale, normalise, hash, PCA, Word2Vec, splits
* ``metrics``      confusion counts and weighted classification scores
* ``models``       reproducible layout, materialisation, trees, k-means, LR, grid search
* ``partitioning`` input parallelism for CPU-heavy per-row work
"""
