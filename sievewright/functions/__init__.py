"""Subpackage of sievewright."""
