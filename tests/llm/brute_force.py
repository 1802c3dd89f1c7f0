"""For each registered query without SQL: the module and the test that hold it against brute force."""

TESTS = {
    "op1_ann_hilbert": ("test_vectors_pages_pipeline", "test_nearest_recall"),
    "op4_language_id": ("test_text_operators", "test_language_of_held_out_documents"),
    "op6_packing": ("test_text_operators", "test_packing_holds_every_id_once"),
    "op8_simhash": ("test_text_operators", "test_simhash_against_all_pairs"),
    "op12_sanitisation": ("test_disclosure", "test_registered_query"),
    "op13_whitening": ("test_whitening", "test_registered_query"),
    "pipeline": ("test_vectors_pages_pipeline", "test_pipeline_stages_take_effect"),
}
