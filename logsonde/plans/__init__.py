"""The whole pipeline and the catalogue of registered queries."""
