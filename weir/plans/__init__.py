"""The three applications, composed of operators."""
