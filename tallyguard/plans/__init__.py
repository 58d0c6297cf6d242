"""Plan shapes that keep the operators safe on skewed and very large inputs."""
