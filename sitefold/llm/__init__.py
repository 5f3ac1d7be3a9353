"""Operations of a training-data pipeline, each a DataFrame -> DataFrame operator.

``mixing``      sources to target weights by weighted pivotal rounding
``token_files`` flat token-id files with 64-bit offsets
``quality``     learned decision lists over text statistics
``licenses``    fuzzy notice search
``urls``        association rules over URL tokens
``topk``        exact inner-product search, columnar branch and bound
``neardup``     MinHash LSH forest
``secrets``     incremental blob ledger
``lm``          subword lattice likelihood
``packing``     cost-balanced sequences
``align``       two tokenisations coalesced over byte intervals
``spelling``    one-edit pairs by composing acceptors
``ngram_join``  Jaccard self-join by an R-tree over group counts
``registry``    the registered queries and their SQL checks
"""
