from conftest_llm import edges, nothing, wide  # noqa: F401
