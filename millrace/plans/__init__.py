"""millrace plans"""
