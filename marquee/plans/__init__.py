"""The build job and the questions asked of its tables."""
