"""The row-local refinement run continuously over arriving cards."""
