"""Pixel kernels, label normalisation, path expressions and graph helpers."""
