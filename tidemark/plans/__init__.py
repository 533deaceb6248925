"""Models and plans composed from the operators."""
