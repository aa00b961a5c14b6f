"""vecspark: vector similarity retrieval as Spark DataFrame work.

Exact and approximate k-nearest-neighbour and radius search, IVF / IVF-PQ
indexes kept as plain tables, packing of vector arrays and merging of
partial top-k lists.
"""

from vecspark.functions.codes import code_array
from vecspark.functions.table import knn_sql, range_sql, register_index, register_sql
from vecspark.model import IndexSpec, SearchOptions, VectorIndex
from vecspark.operators.merge import rank_lists, topk_merge
from vecspark.operators.packing import array_1d_extend, pack_vectors, unpack_vectors
from vecspark.plans.index import (add_vectors, append_to_index, build_index, compact_index, count_vectors, create_index, index_keys,
                                  load_index, reset_index, save_index, set_options, shard_labels, train_index,
                                  with_keys)
from vecspark.plans.search import (from_array_form, knn, range_search, range_search_arrays,
                                   range_search_packed, search, search_packed, to_array_form)

__all__ = [
    "IndexSpec", "SearchOptions", "VectorIndex",
    "create_index", "set_options", "train_index", "add_vectors", "reset_index", "build_index",
    "index_keys", "with_keys", "save_index", "load_index", "append_to_index", "compact_index", "count_vectors", "shard_labels",
    "knn", "range_search", "search", "range_search_arrays", "to_array_form", "from_array_form",
    "search_packed", "range_search_packed",
    "register_sql", "register_index", "knn_sql", "range_sql",
    "code_array", "pack_vectors", "array_1d_extend", "unpack_vectors", "topk_merge", "rank_lists",
]
