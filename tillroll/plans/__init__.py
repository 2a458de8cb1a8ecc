"""How the operators are put together: the model layer and the whole pipeline."""
