"""Scalar expressions shared by the operators."""
