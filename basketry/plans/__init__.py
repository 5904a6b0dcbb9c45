"""Composed jobs and the query registry.

* ``curve``       cart conversion curve (latest cart hour -> share bought)
* ``candidates``  distinct pairs carted in the last day / last hour
* ``features``    recency/count features, training set (label fan-out),
                  scoring set, the shared train+score pair table, and the
                  literal four-aggregate / outer-join form
* ``purchase``    assembler + logistic regression, predicted buyers
* ``spam``        text classifier, grid searches, legacy mllib SGD job
* ``registry``    one query per inventory item for ``__spark_entry__``
* ``oracle``      the independent DuckDB SQL those queries are checked against
"""
