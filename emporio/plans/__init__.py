"""The warehouse models and what is read from them."""
