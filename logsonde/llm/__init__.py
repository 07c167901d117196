"""Operators that prepare text for the training of language models. Nothing outside this folder imports it."""
