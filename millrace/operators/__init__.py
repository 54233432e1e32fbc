"""millrace operators"""
